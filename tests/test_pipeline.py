"""A pipeline that runs: empty storage, bursts, failures, restarts; static sides that change; versions of a table."""

import json
import threading

import pytest
from pyspark.sql import functions as F

from vigilake import storage
from vigilake.plans import medallion, views
from vigilake.plans.pipeline import Pipeline, Settings
from vigilake.plans.registry import Registry
from vigilake.sources.snapshots import Snapshots

NUMBERS = "k string, n long"


def numbers(spark, path, rows):
    spark.createDataFrame(rows, NUMBERS).coalesce(1).write.mode("append").parquet(str(path))


def schema(spark, text):
    return spark.createDataFrame([], text).schema


def flow():
    r = Registry()

    @r.table("doubled", ("numbers",), comment="Twice each number")
    def _(rows):
        return rows.withColumn("n", F.col("n") * 2)

    @r.table("named", ("doubled",), ("names",))
    def _(rows, names):
        return rows.join(names, "k", "left")

    return r


def settings(tmp_path, **given):
    return Settings("test", str(tmp_path / "lake"), continuous=True, every="0 seconds", **given)


def test_settings(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"name": "a", "storage": "s", "target": "gold", "continuous": True}))
    assert Settings.load(spark, str(tmp_path / "p.json")) == Settings("a", "s", "gold", True)
    (tmp_path / "q.json").write_text(json.dumps({"name": "a", "storage": "s", "colour": 1}))
    with pytest.raises(ValueError, match="colour"):
        Settings.load(spark, str(tmp_path / "q.json"))


def test_snapshots(spark, tmp_path):
    t = Snapshots(str(tmp_path / "t"), schema(spark, "k string"))
    assert t.versions(spark) == [] and t.read(spark).count() == 0
    for k in "abcde":
        t.publish(spark.createDataFrame([(k, 1)], "k string, other int"), keep=2)
    assert t.versions(spark) == [3, 4, 5] and [r.k for r in t.read(spark).collect()] == ["e"]
    assert [r.k for r in t.read(spark, 3).collect()] == ["c"]
    # A version without its marker was never published, and its number is not used again.
    storage.move(spark, f"{tmp_path}/t/versions/{5:09d}", f"{tmp_path}/t/versions/{6:09d}")
    storage.delete(spark, f"{tmp_path}/t/markers/{5:09d}")
    assert [r.k for r in t.read(spark).collect()] == ["d"]
    assert t.publish(spark.createDataFrame([("f",)], "k string")) == 7
    assert not storage.create(spark, f"{tmp_path}/t/markers/{7:09d}")
    with pytest.raises(FileExistsError):
        storage.move(spark, f"{tmp_path}/t/versions/{7:09d}", f"{tmp_path}/t/versions/{6:09d}")


def test_versions_of_the_static_side(spark, tmp_path):
    """Each micro-batch joins the version that is current by then; a restart goes on."""
    names = Snapshots(str(tmp_path / "names"), schema(spark, "k string, name string"))
    inputs = {"numbers": (str(tmp_path / "in"), schema(spark, NUMBERS)), "names": names}
    line = Pipeline(spark, flow(), settings(tmp_path, target="piped"), inputs)
    line.run()
    for version in (None, "one", "two"):
        if version:
            names.publish(spark.createDataFrame([("a", version)], "k string, name string"))
        numbers(spark, tmp_path / "in", [("a", 1), ("b", 1)])
        line.drain()
        if version == "one":
            line.stop()
            line = Pipeline(spark, flow(), settings(tmp_path, target="piped"), inputs)
            line.run()
    line.stop()
    want = sorted([("a", 2, None), ("a", 2, "one"), ("a", 2, "two")] + [("b", 2, None)] * 3, key=str)
    assert sorted(map(tuple, line.table("named").collect()), key=str) == want
    assert sorted(map(tuple, spark.table("piped.named").select("k", "n", "name").collect()), key=str) == want
    assert not any(q.isActive for q in line.queries.values())


def test_a_batch_that_comes_again_is_not_written_twice(spark, tmp_path):
    line = Pipeline(spark, flow(), settings(tmp_path), {"numbers": (str(tmp_path / "in"), schema(spark, NUMBERS)), "names": (str(tmp_path / "names"), schema(spark, "k string, name string"))})
    write = line._batches(line.registry.datasets["named"])
    for _ in range(2):
        write(spark.createDataFrame([("a", 1)], NUMBERS), 4)
    assert line.table("named").count() == 1
    with pytest.raises(ValueError, match="over"):
        Registry().table("x", ("a", "b"), ("c",))(lambda a, b, c: a)


def test_failures(spark, tmp_path):
    """A sink that fails twice is started again and misses nothing; one that goes on failing stops the pipeline."""
    inputs = {"numbers": (str(tmp_path / "in"), schema(spark, NUMBERS)), "names": (str(tmp_path / "names"), schema(spark, "k string, name string"))}
    turns, seen, broken = [], [], threading.Event()

    def write(batch, batch_id):
        turns.append(batch_id)
        if len(turns) <= 2 or broken.is_set():
            raise RuntimeError("sink is down")
        seen.extend(r.n for r in batch.collect())

    r = flow()
    r.sink("sink", "doubled")(write)
    line = Pipeline(spark, r, settings(tmp_path, back_off=0.1, max_restarts=3), inputs)
    line.run()
    numbers(spark, tmp_path / "in", [("a", i) for i in range(5)])
    line.drain(60)
    assert sorted(seen) == [0, 2, 4, 6, 8] and turns[:3] == [0, 0, 0]
    broken.set()
    numbers(spark, tmp_path / "in", [("a", 9)])
    with pytest.raises(Exception, match="sink is down"):
        line.wait()
    assert turns.count(1) == 4 and not any(q.isActive for q in line.queries.values())
    with pytest.raises(Exception, match="sink is down"):
        line.drain(5)


def test_pairs(spark, tmp_path):
    """Rows of two streams meet whichever comes first, over a restart; a batch that comes again, or was half kept, changes nothing."""
    r = Registry()

    @r.table("met", ("numbers", "words"), ("names",), pairs=lambda a, b: a.join(b, "k").select("k", "n", "word"), keeps=(("k", "n"), ("word", "k")))
    def _(found, names):
        return found.join(names, "k", "left")

    shapes = {"numbers": NUMBERS + ", other int", "words": "k string, word string", "names": "k string, name string"}
    inputs = {n: (str(tmp_path / n), schema(spark, s)) for n, s in shapes.items()}
    add = lambda n, *rows: spark.createDataFrame(rows, shapes[n]).coalesce(1).write.mode("append").parquet(str(tmp_path / n))
    add("names", ("a", "A"))
    line = Pipeline(spark, r, settings(tmp_path), inputs)
    line.run()
    for turn in ([("numbers", ("a", 1, 0), ("b", 2, 0), (None, 3, 0))], [("words", ("a", "x"), ("a", "y"), (None, "z"))], [("numbers", ("a", 4, 0))], [("words", ("b", "z"))], [("numbers", ("c", 5, 0))]):
        for n, *rows in turn:
            add(n, *rows)
        line.drain()
        if turn[0][0] == "words":
            line.stop()
            line = Pipeline(spark, r, settings(tmp_path), inputs)
            line.run()
    line.stop()
    want = [("a", 1, "x", "A"), ("a", 1, "y", "A"), ("a", 4, "x", "A"), ("a", 4, "y", "A"), ("b", 2, "z", None)]
    rows = lambda: sorted(tuple(x[c] for c in ("k", "n", "word", "name")) for x in line.table("met").collect())
    assert rows() == want
    d = r.datasets["met"]
    assert sorted(tuple(x) for x in d.whole([line.table(n) for n in ("numbers", "words", "names")]).select("k", "n", "word", "name").collect()) == want
    last = [(("e", 6), None, "left"), (None, ("z", "e"), "right")]
    batch = spark.createDataFrame(last, "left struct<k:string,n:bigint>, right struct<word:string,k:string>, __side string")
    write = line._paired(d, batch.schema)
    write(batch.filter("__side = 'left'"), 9)  # kept, then lost before its pairs were there
    storage.delete(spark, f"{line._path('met')}/batch-{9:09d}")
    for _ in range(2):
        write(batch, 9)
    assert rows() == sorted([*want, ("e", 6, "z", None)])
    with pytest.raises(ValueError, match="pairs"):
        Registry().table("x", ("a",), pairs=lambda a, b: a)(lambda a: a)


def test_cards_of_old_transactions(spark, tmp_path):
    """The later half of the transactions comes first, and the alerts are those of the batch; no row is held as state, of which executors keep all in memory."""
    given, sf_dir = {}, "/root/testdata/sf0.001"
    given["transaction_messages"], given["customer_profiles"] = views.messages(spark, sf_dir), views.customers(spark, sf_dir)
    given["watchlist_files"] = views.watchlist(spark, sf_dir).withColumn("source_file", F.lit("f"))
    line = Pipeline(spark, medallion.build(), settings(tmp_path), {n: (str(tmp_path / "in" / n), df.schema) for n, df in given.items()})
    arrive = lambda n, where: given[n].filter(where).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / n))
    line.run()
    for name, where in (("customer_profiles", "true"), ("watchlist_files", "true"), ("transaction_messages", "timestamp >= '2024-01-16'"), ("transaction_messages", "timestamp < '2024-01-16'")):
        arrive(name, where)
        line.drain()
    line.stop()
    want = line.registry.run_batch(given)["fraud_card_alerts"]
    ids = lambda df: sorted(x.alert_id for x in df.select("alert_id").collect())
    assert ids(line.table("fraud_card_alerts")) == ids(want) and want.count() > 50
    assert not storage.exists(spark, f"{line.settings.storage}/checkpoints/fraud_card_alerts/state")
