"""Transactions, customers, merchants and watchlists over the star-schema test tables; each beside the same view in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake import schemas

CITIES = ("Delhi", "London", "Mumbai", "Pune")
CATEGORIES = ("Grocery", "Fuel", "Restaurant", "Hotel", "Electronics", "Jewellery", "ATM", "Pharmacy", "Shopping", "Airline", "Entertainment", "Travel")
CHANNELS = ("POS", "MOBILE_APP", "INTERNET_BANKING")


def _choice(key: str, values: tuple[str, ...]) -> str:
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


def _select(dialect: str, columns: dict[str, str], source: str) -> str:
    f = {"spark": "format_string", "duck": "printf"}[dialect]
    ts = {"spark": "timestamp", "duck": "TIMESTAMP"}[dialect]
    return "SELECT " + ", ".join(f"{e.replace('@fmt', f).replace('@ts', ts)} AS {n}" for n, e in columns.items()) + f" FROM {source}"


_TRANSACTIONS = {
    "transaction_id": "@fmt('TXN%07d', event_id)",
    "customer_id": "@fmt('CUST%06d', user_id)",
    "card_number": "@fmt('4%015d', user_id)",
    "merchant_id": "@fmt('MER%04d', event_id % 97)",
    "merchant_name": "@fmt('Shop %d', event_id % 97)",
    "merchant_category": _choice("event_id", CATEGORIES),
    "amount": "value",
    "currency": "CASE WHEN event_id % 7 = 0 THEN 'USD' ELSE 'INR' END",
    "transaction_type": "upper(event_type)",
    "payment_channel": _choice("event_id", CHANNELS),
    "device_id": "concat('DEV', regexp_extract(props, '([0-9]+)', 1))",
    "city": _choice("event_id", CITIES),
    "country": "CASE WHEN event_id % 4 = 1 THEN 'United Kingdom' ELSE 'India' END",
    "transaction_timestamp": "CAST(ts AS @ts)",
    "is_international": "event_id % 7 = 0",
    "status": "'APPROVED'",
}
_CUSTOMERS = {
    "customer_id": "@fmt('CUST%06d', c_custkey)",
    "first_name": "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE substr(c_name, 1, 8) END",
    "last_name": "substr(c_name, 10)",
    "gender": _choice("c_custkey", ("Male", "Female", "Other")),
    "age": "CAST(18 + c_custkey % 58 AS INT)",
    "city": _choice("c_custkey", CITIES),
    "state": "'State'",
    "country": "'India'",
    "annual_income": "c_acctbal * 100",
    "customer_segment": "c_mktsegment",
    "account_open_date": "@fmt('20%02d-%02d-%02d', 10 + c_custkey % 15, 1 + c_custkey % 12, 1 + c_custkey % 30)",
    "risk_score": "CAST(5 + (c_custkey * 7) % 96 AS DOUBLE)",
    "preferred_spending_min": "c_acctbal * 2",
    "preferred_spending_max": "c_acctbal * 10",
    "preferred_city": _choice("c_custkey", CITIES),
    "preferred_country": "'India'",
    "trusted_device_id": "concat('DEV', CAST(c_custkey % 100 AS VARCHAR(9)))",
    "card_number": "@fmt('4%015d', c_custkey)",
    "card_type": _choice("c_custkey", ("Visa", "Mastercard", "RuPay", "Amex")),
    "email": "concat('c', CAST(c_custkey AS VARCHAR(19)), '@example.com')",
    "transaction_limit": "c_acctbal * 0.05",
}
_MERCHANTS = {
    "merchant_id": "@fmt('MER%04d', s_suppkey)",
    "merchant_name": "s_name",
    "merchant_category": _choice("s_suppkey", CATEGORIES),
    "city": _choice("s_suppkey", CITIES),
    "country": "'India'",
    "merchant_risk": "CASE WHEN s_suppkey % 10 = 0 THEN 'HIGH' WHEN s_suppkey % 10 < 4 THEN 'MEDIUM' ELSE 'LOW' END",
    "is_blacklisted": "s_suppkey % 20 = 5",
}
_MONTHS = ("Jan", "FEB", "mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
_WATCHLIST = {
    "watchlist_id": "@fmt('wl%06d', c_custkey)",
    "watch_type": "'card'",
    "entity_id": "@fmt('4%015d', c_custkey)",
    "risk_level": _choice("c_custkey", ("high", "Medium", "CRITICAL")),
    "action": _choice("c_custkey", ("block", "review")),
    "reason_code": "@fmt('R%02d', c_custkey % 20)",
    "reason_description": "'reported'",
    "status": _choice("c_custkey", ("active", "inactive")),
    "effective_from": "CASE WHEN c_custkey % 13 = 0 THEN 'unknown' ELSE " + f"concat(@fmt('%02d-', 1 + c_custkey % 28), {_choice('c_custkey', _MONTHS)}, @fmt('-2024 %02d:30:00', c_custkey % 24)) END",
    "reported_by": "'bank'",
    "reported_source": "'feed'",
    "country": "CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'India' END",
    "city": "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'Pune' END",
}
LISTED = "c_acctbal < 0"

SQL = {
    "transactions": _select("duck", _TRANSACTIONS, "events"),
    "customers": _select("duck", _CUSTOMERS, "customer"),
    "merchants": _select("duck", _MERCHANTS, "supplier"),
    "watchlist": _select("duck", _WATCHLIST, f"customer WHERE {LISTED}"),
}


def _view(spark: SparkSession, sf_dir: str, table: str, columns: dict[str, str], where: str | None = None) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    rows = rows.filter(where) if where else rows
    return rows.selectExpr(*[f"{e.replace('@fmt', 'format_string').replace('@ts', 'timestamp')} AS {n}" for n, e in columns.items()])


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "events", _TRANSACTIONS)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "customer", _CUSTOMERS)


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "supplier", _MERCHANTS)


def watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "customer", _WATCHLIST, LISTED)


#: Each 97th message is broken off, and each 89th lacks its card.
BROKEN, NO_CARD = 97, 89


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions as Kafka's columns, with some messages that must not come through."""
    t = transactions(spark, sf_dir).withColumn("n", F.substring("transaction_id", 4, 19).cast("long"))
    t = t.withColumn("card_number", F.when(F.col("n") % NO_CARD != 0, F.col("card_number")))
    body = F.to_json(F.struct(*schemas.TRANSACTION.names))
    value = F.when(F.col("n") % BROKEN == 0, F.substring(body, 1, 20)).otherwise(body)
    return t.select(F.col("transaction_id").cast("binary").alias("key"), value.cast("binary").alias("value"), F.lit("transactions").alias("topic"), F.lit(0).alias("partition"), F.col("n").alias("offset"), F.col("transaction_timestamp").alias("timestamp"), F.lit(0).alias("timestampType"))
