"""Feeds: the simulator as a stream of messages, and sinks that send them."""

from __future__ import annotations

import contextlib
import signal
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vigilake.config import KafkaConfig, SimulatorSettings
from vigilake.plans import simulate
from vigilake.sources.kafka import sink_options


def ticks(spark: SparkSession, settings: SimulatorSettings) -> DataFrame:
    """seq and timestamp at the settings' rate (a whole number of rows a second, one at least)."""
    return spark.readStream.format("rate").option("rowsPerSecond", max(1, round(settings.transactions_per_second))).load().select(F.col("value").alias("seq"), "timestamp")


def feed(batch: DataFrame, people: DataFrame, shops: DataFrame, settings: SimulatorSettings) -> DataFrame:
    """Messages for a batch of ticks: each row's transaction is the simulator's of that number, at the tick's time."""
    made = simulate.transactions(batch.sparkSession, batch, settings, people, shops)
    return simulate.as_messages(simulate.normal_feed(made.drop("transaction_timestamp").join(batch.withColumnRenamed("timestamp", "transaction_timestamp"), "seq"), settings.seed))


def kafka_writer(messages: DataFrame, config: KafkaConfig):
    """A batch writer to the topic, durable and idempotent."""
    return messages.write.format("kafka").options(**sink_options(config))


@contextlib.contextmanager
def stopping(queries: list[StreamingQuery]) -> Iterator[None]:
    """Stops the queries in order on SIGINT, SIGTERM or the end of the block."""

    def stop(*_: object) -> None:
        for q in queries:
            if q.isActive:
                q.stop()

    before = {s: signal.signal(s, stop) for s in (signal.SIGINT, signal.SIGTERM)}
    try:
        yield
    finally:
        stop()
        for s, handler in before.items():
            signal.signal(s, handler)
