"""The bronze, silver and gold datasets, wired together."""

from __future__ import annotations

from pyspark.sql import DataFrame

from vigilake import schemas
from vigilake.operators import alerts, refine, windows
from vigilake.plans.registry import Registry

WATERMARK = "5 minutes"


def build() -> Registry:
    """Nine datasets over the inputs transaction_messages, watchlist_files and customer_profiles."""
    r = Registry()

    @r.table("bronze_transactions", ("transaction_messages",), comment="Messages as they came in")
    def _(messages: DataFrame) -> DataFrame:
        return refine.bronze_transactions(messages)

    @r.table("bronze_watchlist", ("watchlist_files",), comment="Watchlist files as they came in")
    def _(files: DataFrame) -> DataFrame:
        return refine.bronze_watchlist(files)

    @r.table("silver_transactions", ("bronze_transactions",), comment="Typed transactions with all ids")
    def _(bronze: DataFrame) -> DataFrame:
        return refine.silver_transactions(bronze)

    @r.table("silver_watchlist", ("bronze_watchlist",), comment="Normalised watchlist")
    def _(bronze: DataFrame) -> DataFrame:
        return refine.silver_watchlist(bronze)

    @r.table("silver_customers", ("customer_profiles",), comment="Customer profiles")
    def _(bronze: DataFrame) -> DataFrame:
        return refine.silver_customers(bronze)

    @r.table("high_value_alerts", ("silver_transactions",), ("silver_customers",), comment="Transactions above the customer's limit")
    def _(transactions: DataFrame, customers: DataFrame) -> DataFrame:
        return alerts.high_value_alerts(transactions, customers)

    @r.table("fraud_card_alerts", ("silver_transactions", "silver_watchlist"), ("silver_customers",), comment="Transactions of listed cards", pairs=alerts.card_matches, keeps=(tuple(schemas.TRANSACTION.names), tuple(schemas.WATCHLIST.names)))
    def _(matched: DataFrame, customers: DataFrame) -> DataFrame:
        return alerts.as_card_alerts(matched, customers)

    @r.table("transactions_per_minute", ("silver_transactions",), comment="Transactions of each minute")
    def _(transactions: DataFrame) -> DataFrame:
        return windows.per_minute(transactions, watermark=WATERMARK)

    @r.table("transactions_sliding", ("silver_transactions",), comment="Transactions of five minutes, by minute")
    def _(transactions: DataFrame) -> DataFrame:
        return windows.five_minutes_sliding(transactions, watermark=WATERMARK)

    return r
