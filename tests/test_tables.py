"""Tables, files one by one, and the simulator's SQL."""

import time
import uuid

import pytest
from pyspark.errors import AnalysisException

from tests.conftest import SF
from vigilake import schemas
from vigilake.config import SimulatorSettings
from vigilake.operators import watchlist
from vigilake.plans import medallion, registry, simulate, views
from vigilake.sources import files
from vigilake.streaming import replay


def test_batch_tables(spark):
    registry.create_databases(spark, ("one", "two"))
    registry.use_database(spark, "one")
    try:
        registry.save_table(spark.range(3), "numbers")
        assert spark.table("one.numbers").count() == 3
        with pytest.raises(AnalysisException):
            registry.save_table(spark.range(3), "numbers")
        inputs = {"transaction_messages": views.messages(spark, SF), "watchlist_files": views.watchlist(spark, SF).selectExpr("*", "'f' AS source_file"), "customer_profiles": views.customers(spark, SF)}
        made = medallion.build().save_batch(inputs, prefix="two.")
        assert {t.name for t in spark.catalog.listTables("two")} == set(made) - set(inputs)
        assert spark.table("two.high_value_alerts").count() == made["high_value_alerts"].count() > 0
    finally:
        registry.use_database(spark, "default")
        for name in ("one", "two"):
            spark.sql(f"DROP DATABASE {name} CASCADE")


def test_drip_and_head(spark, tmp_path):
    rows = spark.createDataFrame([(f"WL{i}",) + (None,) * 12 for i in (3, 1, 2)], schemas.WATCHLIST)
    start = time.time()
    assert watchlist.drip(rows, str(tmp_path / "d"), seconds=0.2, stamp="S", first=7) == 3 and time.time() - start > 0.4
    names = sorted(p.name for p in (tmp_path / "d").glob("*.json"))
    assert names == [f"fraud_watchlist_S_{i}.json" for i in (7, 8, 9)]
    assert files.head(spark, str(tmp_path / "d" / names[0])) == '{"watchlist_id":"WL1"}\n' and files.head(spark, str(tmp_path / "d" / names[0]), 5) == '{"wat'
    assert sorted(p.rsplit("/", 1)[-1] for p, in files.listing(spark, str(tmp_path / "d"), "*.json").select("path").collect()) == names
    assert watchlist.drip(rows.limit(0), str(tmp_path / "e"), seconds=0) == 0


def test_places_and_names_go_together(spark):
    people = simulate.customers(spark, SimulatorSettings(customers=500))
    assert {tuple(r) for r in people.select("city", "state", "country").distinct().collect()} == {(c, s, "India") for c, s in simulate.INDIAN_PLACES} | set(simulate.FOREIGN)
    for r in simulate.merchants(spark).collect():
        assert r.merchant_name.rsplit(" ", 1) == [r.merchant_name.rsplit(" ", 1)[0], str(int(r.merchant_id[3:]))] and r.merchant_name.rsplit(" ", 1)[0] in simulate.SHOPS[r.merchant_category]


def test_executors_write_an_unpaced_drip(spark, tmp_path, monkeypatch):
    """Files come in the order of ids over several ranges, and no text comes to the driver."""
    rows = spark.range(300, numPartitions=7).selectExpr("concat('WL', lpad(cast((id * 77) % 300 as string), 4, '0')) AS watchlist_id", "'x' AS city").unionByName(spark.createDataFrame([(None, "é")], "watchlist_id string, city string"))

    def refuse(*_):
        raise AssertionError("rows come to the driver")

    monkeypatch.setattr(type(rows), "toLocalIterator", refuse)
    assert watchlist.drip(rows, str(tmp_path / "d"), seconds=0, stamp="S", first=5) == 301
    assert sorted(p.name for p in (tmp_path / "d").iterdir() if p.name[0] != ".") == sorted(f"fraud_watchlist_S_{i}.json" for i in range(5, 306))
    texts = [(tmp_path / "d" / f"fraud_watchlist_S_{i}.json").read_text() for i in range(5, 306)]
    assert texts == ['{"city":"é"}\n'] + [f'{{"watchlist_id":"WL{i:04d}","city":"x"}}\n' for i in range(300)]


def test_a_stream_of_many_files_lists_them_in_few_tasks(spark, tmp_path):
    rows = spark.range(60).selectExpr("format_string('WL%04d', id) AS watchlist_id")
    watchlist.drip(rows, str(tmp_path / "d"), seconds=0)
    got = replay.to_table(spark, files.json_stream(spark, str(tmp_path / "d"), rows.schema), f"listed_{uuid.uuid4().hex}")
    assert got.count() == 60
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
    assert max(stages.apply(i).numTasks() for i in range(min(8, stages.size()))) < 60
