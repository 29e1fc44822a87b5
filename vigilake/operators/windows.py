"""Counts of transactions in windows of event time; rows without a time are in none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def window_counts(transactions: DataFrame, length: str, slide: str | None = None, time: str = "transaction_timestamp", watermark: str | None = None) -> DataFrame:
    """window_start, window_end, transaction_count of each window that has a row. watermark: for streams."""
    if watermark:
        transactions = transactions.withWatermark(time, watermark)
    w = F.window(time, length, slide) if slide else F.window(time, length)
    counts = transactions.groupBy(w.alias("window")).agg(F.count(F.lit(1)).alias("transaction_count"))
    return counts.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "transaction_count")


def per_minute(transactions: DataFrame, **given: str) -> DataFrame:
    return window_counts(transactions, "1 minute", **given)


def five_minutes_sliding(transactions: DataFrame, **given: str) -> DataFrame:
    """Five-minute windows that begin each minute: a row is in five of them."""
    return window_counts(transactions, "5 minutes", "1 minute", **given)


def latest(counts: DataFrame, n: int = 10) -> DataFrame:
    """The last n windows, the newest first."""
    return counts.orderBy(F.desc("window_start")).limit(n)
