"""Dashboard queries over alert and transaction tables. `as_of` stands for now."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def recent(alerts: DataFrame, as_of: Column, interval: str = "1 HOUR") -> DataFrame:
    return alerts.filter(F.col("alert_timestamp") >= as_of - F.expr(f"INTERVAL {interval}"))


def newest_first(alerts: DataFrame) -> DataFrame:
    return alerts.orderBy(F.desc("alert_timestamp"))


def summary_by_risk(fraud_alerts: DataFrame, as_of: Column) -> DataFrame:
    """alert_type, risk_level, alert_count, avg_amount of the last hour."""
    return recent(fraud_alerts, as_of).groupBy("alert_type", "risk_level").agg(F.count(F.lit(1)).alias("alert_count"), F.avg("amount").alias("avg_amount"))


def count_rows(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("row_count"))


def high_risk_customers(customers: DataFrame, threshold: float = 70) -> DataFrame:
    return customers.filter(F.col("risk_score") >= threshold).agg(F.count(F.lit(1)).alias("high_risk_customers"))


def alerts_last_hour(tables: list[DataFrame], as_of: Column) -> DataFrame:
    """How many alerts all tables have within the hour."""
    return recent(_times(tables), as_of).agg(F.count(F.lit(1)).alias("alerts_last_hour"))


def _times(tables: list[DataFrame]) -> DataFrame:
    out = None
    for t in tables:
        t = t.select("alert_type", "alert_timestamp")
        out = t if out is None else out.unionAll(t)
    return out


def type_distribution(tables: list[DataFrame]) -> DataFrame:
    return _times(tables).groupBy("alert_type").agg(F.count(F.lit(1)).alias("alert_count"))


def amount_trend(transactions: DataFrame, bucket: str = "1 hour") -> DataFrame:
    """bucket_start, avg_amount, transaction_count of each bucket that has a transaction."""
    by = transactions.groupBy(F.window("transaction_timestamp", bucket).alias("w"))
    return by.agg(F.avg("amount").alias("avg_amount"), F.count(F.lit(1)).alias("transaction_count")).select(F.col("w.start").alias("bucket_start"), "avg_amount", "transaction_count")


def production_stats(scored: DataFrame) -> DataFrame:
    """produced, fraud_percentage, runtime_seconds (by event time), average_tps of scored transactions, in one row."""
    span = (F.unix_micros(F.max("transaction_timestamp")) - F.unix_micros(F.min("transaction_timestamp"))) / 1e6
    s = scored.agg(F.count(F.lit(1)).alias("produced"), (100.0 * F.avg(F.when(F.col("fraud_score") > 0, 1.0).otherwise(0.0))).alias("fraud_percentage"), span.alias("runtime_seconds"))
    return s.withColumn("average_tps", F.when(F.col("runtime_seconds") > 0, F.col("produced") / F.col("runtime_seconds")))
