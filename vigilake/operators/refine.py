"""From raw to refined rows: transactions, watchlist, customers. `as_of` stamps the time of processing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from vigilake import schemas
from vigilake.functions import times
from vigilake.operators import expectations as E

TRANSACTION_EXPECTATIONS = [
    *[E.Expectation(f"valid_{c}", f"{c} IS NOT NULL", E.DROP) for c in ("transaction_id", "customer_id", "card_number", "merchant_id")],
    E.Expectation("valid_amount", "amount > 0", E.WARN),
]
CUSTOMER_EXPECTATIONS = [E.Expectation("valid_customer_id", "customer_id IS NOT NULL", E.DROP)]


def bronze_transactions(envelope: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Kafka's columns with key and value as text, and the time they came in."""
    return envelope.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "topic", "partition", "offset", "timestamp", "timestampType", (as_of if as_of is not None else F.current_timestamp()).alias("ingestion_timestamp"))


def silver_transactions(bronze: DataFrame, as_of: Column | None = None, observe: str | Observation | None = None) -> DataFrame:
    """The fields of each message, typed, with where it came from. What is no JSON object has no ids and is dropped.

    The parse is a generator of one row, below which no filter can go: each message is parsed once."""
    parsed = bronze.select(
        F.inline(F.array(F.from_json("value", schemas.TRANSACTION))),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("ingestion_timestamp").alias("bronze_ingestion_timestamp"),
    )
    rows = parsed.select(*schemas.TRANSACTION.names, "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "bronze_ingestion_timestamp", (as_of if as_of is not None else F.current_timestamp()).alias("silver_ingestion_timestamp"))
    return E.apply(rows, TRANSACTION_EXPECTATIONS, observe)


def bronze_watchlist(files: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The 13 fields and _rescued_data of files.rescued(), with the file each row came from.

    A source_file column is kept where there is one; else it is taken from the file source."""
    origin = F.col("source_file") if "source_file" in files.columns else F.col("_metadata.file_path")
    rescued = F.col("_rescued_data") if "_rescued_data" in files.columns else F.lit(None).cast("string")
    return files.select(*schemas.WATCHLIST.names, rescued.alias("_rescued_data"), origin.alias("source_file"), (as_of if as_of is not None else F.current_timestamp()).alias("ingestion_timestamp"))


def silver_watchlist(bronze: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Ids, risk and action in capitals, the effective time parsed; no row is dropped."""
    upper = {"watchlist_id", "entity_id", "risk_level", "action"}
    column = lambda c: F.upper(c).alias(c) if c in upper else times.watchlist_time(F.col(c)).alias(c) if c == "effective_from" else F.col(c)
    return bronze.select(*map(column, schemas.WATCHLIST.names), "source_file", F.col("ingestion_timestamp").alias("bronze_ingestion_timestamp"), (as_of if as_of is not None else F.current_timestamp()).alias("silver_ingestion_timestamp"))


def silver_customers(bronze: DataFrame, as_of: Column | None = None, observe: str | Observation | None = None) -> DataFrame:
    """The 21 profile columns with the opening date parsed; rows without an id are dropped."""
    column = lambda c: times.iso_date(F.col(c).cast("string")).alias(c) if c == "account_open_date" else F.col(c)
    rows = bronze.select(*map(column, schemas.CUSTOMER.names), (as_of if as_of is not None else F.current_timestamp()).alias("silver_ingestion_timestamp"))
    return E.apply(rows, CUSTOMER_EXPECTATIONS, observe)
