import pytest
from pyspark.sql import functions as F

from vigilake.config import ConfigError, EnvSecrets, KafkaConfig, SimulatorSettings
from vigilake.functions import text
from vigilake.plans import registry, reports
from vigilake.sources import kafka

SECRET = '{"bootstrap_servers": "b:9092", "topic": "t", "api_key": "k", "api_secret": "s\\"x"}'


def test_settings():
    s = SimulatorSettings.from_env({"TRANSACTIONS_PER_SECOND": "2", "CUSTOMER_COUNT": "7"})
    assert (s.transactions_per_second, s.customers, s.merchants, s.fraud_percentage, s.seed) == (2.0, 7, 200, 0.08, 42)
    for bad in ({"transactions_per_second": 0}, {"fraud_percentage": 1.1}, {"customers": 0}, {"merchants": -1}):
        with pytest.raises(ConfigError):
            SimulatorSettings(**bad)
    with pytest.raises(ConfigError):
        SimulatorSettings.from_env({"RANDOM_SEED": "x"})


def test_secrets_and_kafka_options():
    c = KafkaConfig.from_secret(EnvSecrets({"FEED__KAFKA": SECRET}), "feed", "kafka")
    assert "s\"x" not in repr(c) and "'k'" not in repr(c)
    for env in ({}, {"FEED__KAFKA": "{}"}, {"FEED__KAFKA": "no"}):
        with pytest.raises(ConfigError):
            KafkaConfig.from_secret(EnvSecrets(env), "feed", "kafka")
    o = kafka.source_options(c, max_offsets_per_trigger=10, min_partitions=8)
    assert (o["subscribe"], o["startingOffsets"], o["kafka.security.protocol"], o["kafka.sasl.mechanism"], o["maxOffsetsPerTrigger"], o["minPartitions"]) == ("t", "earliest", "SASL_SSL", "PLAIN", "10", "8")
    assert o["kafka.sasl.jaas.config"].endswith('username="k" password="s\\"x";')
    assert kafka.sink_options(c)["kafka.acks"] == "all"


def test_text(spark):
    df = spark.createDataFrame([("1234567812345678",), ("",), (None,), ("12",)], "c string")
    assert [r[0] for r in df.select(text.mask_card(F.col("c"))).collect()] == ["5678", "****", "****", "12"]
    one = spark.range(1).select(text.full_name(F.lit(None), F.lit(None)), text.money(F.lit(1234567.891)), text.numbered("TXN", F.lit(123456789), 7), text.or_default(F.lit("")), text.yes_no(F.lit(None).cast("boolean")), text.escape_html(F.lit("<a href='x'>&\"")), text.luhn_digit(F.lit("7992739871"))).first()
    assert tuple(one) == ("", "1,234,567.89", "TXN123456789", "N/A", "No", "&lt;a href=&#39;x&#39;&gt;&amp;&quot;", "3")


def test_weighted_choice(spark):
    r = spark.range(20000).select(text.weighted_choice(text.uniform(1, "x", F.col("id")), [("a", 3), ("b", 1)]).alias("v")).groupBy("v").count().collect()
    got = {x.v: x["count"] / 20000 for x in r}
    assert abs(got["a"] - 0.75) < 0.02


def test_registry_refuses_cycles_and_repeats():
    r = registry.Registry()
    r.table("a", ("b",))(lambda x: x)
    with pytest.raises(ValueError):
        r.table("a", ("c",))(lambda x: x)
    r.table("b", ("a",))(lambda x: x)
    with pytest.raises(ValueError):
        r.order()


def test_databases_and_counts(spark):
    registry.create_databases(spark)
    registry.create_databases(spark)
    assert {"bronze", "silver", "gold", "alert"} <= {d.name for d in spark.catalog.listDatabases()}
    spark.range(3).write.mode("overwrite").saveAsTable("bronze.smoke")
    assert reports.count_rows(spark.read.table("bronze.smoke")).first()[0] == 3
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        spark.range(3).write.saveAsTable("bronze.smoke")
