"""Options of Kafka sources and sinks. The connector itself is a package of the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigilake.config import KafkaConfig

LOGIN_MODULE = "org.apache.kafka.common.security.plain.PlainLoginModule"


def _quoted(text: str) -> str:
    return '"' + text.replace("\\", "\\\\").replace('"', '\\"') + '"'


def security_options(config: KafkaConfig) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": config.bootstrap_servers,
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": f"{LOGIN_MODULE} required username={_quoted(config.api_key)} password={_quoted(config.api_secret)};",
    }


def source_options(config: KafkaConfig, starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None, min_partitions: int | None = None) -> dict[str, str]:
    """Options of a source that subscribes to one topic; rates are limited where given."""
    options = security_options(config) | {"subscribe": config.topic, "startingOffsets": starting_offsets}
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def sink_options(config: KafkaConfig) -> dict[str, str]:
    """Options of a sink that acknowledges by all replicas, retries and is idempotent."""
    return security_options(config) | {"topic": config.topic, "kafka.acks": "all", "kafka.retries": "5", "kafka.retry.backoff.ms": "500", "kafka.enable.idempotence": "true"}


def read_stream(spark: SparkSession, config: KafkaConfig, **limits: int) -> DataFrame:
    return spark.readStream.format("kafka").options(**source_options(config, **limits)).load()


def read_batch(spark: SparkSession, config: KafkaConfig) -> DataFrame:
    return spark.read.format("kafka").options(**source_options(config)).load()
