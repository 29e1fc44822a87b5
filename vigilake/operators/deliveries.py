"""At-least-once delivery made exactly-once again."""

from __future__ import annotations

from pyspark.sql import DataFrame


def once(rows: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """Rows whose keys came before are dropped.

    In a stream a key is remembered until the watermark is `delay` beyond its row; what comes later than that is behind the
    watermark itself. A batch has no such end. Of rows of one key any may be the one that stays."""
    if not rows.isStreaming:
        return rows.dropDuplicates(keys)
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)
