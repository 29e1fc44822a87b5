"""Alerts: transactions above a customer's limit, and transactions of listed cards.

No side is hinted for broadcast: statistics decide, so customers and watchlists may grow. Keys that repeat
on either side fan out. The same functions serve streams (transactions and watchlist) and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake.functions import text

HIGH_VALUE, FRAUD_CARD = "HIGH_VALUE_TRANSACTION", "FRAUD_CARD_TRANSACTION"


def high_value_alerts(transactions: DataFrame, customers: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Transactions with amount > transaction_limit of their customer. Null on either side: no alert. 19 columns."""
    t, c = transactions.alias("t"), customers.alias("c")
    # The filter rejects customers that are missing, so the left join runs as an inner one.
    met = t.join(c, F.col("t.customer_id") == F.col("c.customer_id"), "left").filter("t.amount > c.transaction_limit")
    return met.select(
        text.tagged(F.lit("ALERT"), F.col("t.transaction_id")).alias("alert_id"),
        F.lit(HIGH_VALUE).alias("alert_type"),
        (as_of if as_of is not None else F.current_timestamp()).alias("alert_timestamp"),
        "t.transaction_id",
        "t.customer_id",
        F.col("c.email").alias("customer_email"),
        text.full_name(F.col("c.first_name"), F.col("c.last_name")).alias("customer_name"),
        F.col("t.amount").alias("transaction_amount"),
        "c.transaction_limit",
        *[f"t.{x}" for x in ("currency", "merchant_name", "merchant_category", "transaction_type", "payment_channel", "city", "country", "is_international", "transaction_timestamp", "status")],
    )


def card_matches(transactions: DataFrame, watchlist: DataFrame, retention: str | None = None, watermark: str | None = None, salts: int = 1) -> DataFrame:
    """t, w: transactions with the listings of their card, whatever a listing's status, type or date.

    retention: an interval such as '10 minutes'; only transactions within that time after the listing match then, which
    bounds a stream's state: a listing goes once its time is over for both watermarks, a transaction once no listing can still
    be early enough. Without it (the default) every pair matches and a stream keeps all rows.
    watermark: delay of both sides, for streams. salts: into so many parts each card's transactions are dealt, by their id;
    listings, which are few, go to each part. A card with a third of all transactions is then the work of so many tasks."""
    if watermark:
        transactions, watchlist = transactions.withWatermark("transaction_timestamp", watermark), watchlist.withWatermark("effective_from", watermark)
    t, w = transactions.alias("t"), watchlist.alias("w")
    on = F.col("t.card_number") == F.col("w.entity_id")
    names = {"t": transactions.columns, "w": watchlist.columns}
    if salts > 1:
        t = transactions.withColumn("__salt", F.pmod(F.xxhash64("transaction_id"), F.lit(salts)).cast("int")).alias("t")
        w = watchlist.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).alias("w")
        on = on & (F.col("t.__salt") == F.col("w.__salt"))
    if retention:
        on = on & F.expr(f"t.transaction_timestamp >= w.effective_from AND t.transaction_timestamp <= w.effective_from + INTERVAL {retention}")
    return t.join(w, on).select(*[F.struct(*[F.col(f"{side}.{n}") for n in found]).alias(side) for side, found in names.items()])


def fraud_card_alerts(transactions: DataFrame, watchlist: DataFrame, customers: DataFrame, as_of: Column | None = None, retention: str | None = None, watermark: str | None = None, salts: int = 1) -> DataFrame:
    """Transactions whose card is listed, with their customers: as_card_alerts() of card_matches()."""
    return as_card_alerts(card_matches(transactions, watchlist, retention, watermark, salts), customers, as_of)


def as_card_alerts(matches: DataFrame, customers: DataFrame, as_of: Column | None = None) -> DataFrame:
    """32 columns for each match. Customers that are missing leave e-mail null and the name empty."""
    c = customers.alias("c")
    met = matches.join(c, F.col("t.customer_id") == F.col("c.customer_id"), "left")
    return met.select(
        text.tagged(F.lit("FRAUD"), F.col("t.transaction_id"), F.col("w.watchlist_id")).alias("alert_id"),
        F.lit(FRAUD_CARD).alias("alert_type"),
        (as_of if as_of is not None else F.current_timestamp()).alias("alert_timestamp"),
        "t.transaction_id",
        "t.customer_id",
        F.col("c.email").alias("customer_email"),
        text.full_name(F.col("c.first_name"), F.col("c.last_name")).alias("customer_name"),
        *[f"t.{x}" for x in ("card_number", "amount", "currency", "merchant_id", "merchant_name", "merchant_category", "transaction_type", "payment_channel", "device_id")],
        F.col("t.city").alias("transaction_city"),
        F.col("t.country").alias("transaction_country"),
        "t.transaction_timestamp",
        "t.is_international",
        F.col("t.status").alias("transaction_status"),
        *[f"w.{x}" for x in ("watchlist_id", "watch_type", "risk_level", "action", "reason_code", "reason_description")],
        F.col("w.effective_from").alias("watchlist_effective_from"),
        "w.reported_by",
        "w.reported_source",
        F.col("w.city").alias("watchlist_city"),
        F.col("w.country").alias("watchlist_country"),
    )
