"""What running streams hold, read from their checkpoints as tables: windows that are still open, rows that wait for a match."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """operatorId, operatorName, stateStoreName, numPartitions, minBatchId, maxBatchId of each stateful operator."""
    return spark.read.format("state-metadata").load(checkpoint)


def open_windows(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """window_start, window_end, transaction_count of windows.window_counts() that the watermark has not closed yet; a partition of state is a task."""
    state = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
    window, count = F.col(f"key.{state.schema['key'].dataType.names[0]}"), F.col(f"value.{state.schema['value'].dataType.names[0]}")
    return state.select(window["start"].alias("window_start"), window["end"].alias("window_end"), count.alias("transaction_count"))


def waiting(spark: SparkSession, checkpoint: str, side: str, operator: int = 0) -> DataFrame:
    """The rows that a stream-stream join holds of its left or right side."""
    state = spark.read.format("statestore").option("operatorId", operator).option("joinSide", side).load(checkpoint)
    return state.select("value.*")
