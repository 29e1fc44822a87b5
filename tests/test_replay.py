"""Turns that are written in one pass, and turns of several inputs."""

import os

from pyspark.sql import functions as F

from vigilake import storage
from vigilake.streaming import replay


def test_turns_of_one_pass(spark):
    """Each turn's folder has its rows, those that come twice in both, and a turn without rows is there too."""
    rows, turn = spark.range(20).withColumn("name", F.concat(F.lit("n"), "id")), F.col("id") % 3
    folders = replay.staged(rows, F.explode(F.array(turn, turn + 1)), 5)
    for k, folder in enumerate(folders):
        want = sorted(i for i in range(20) if k in (i % 3, i % 3 + 1))
        assert sorted(r.id for r in spark.read.schema(rows.schema).parquet(folder).filter("name = concat('n', id)").collect()) == want
    run = replay.in_turns(spark, {"t": rows.schema}, lambda t: t, [{"t": f} for f in folders])
    assert sorted(r.id for r in run.out().collect()) == sorted([*range(20)] * 2)


def test_inputs_of_a_turn_are_written_before_any_is_seen(spark, monkeypatch):
    waiting, move = [], storage.move

    def seen(s, source, target):
        waiting.append(len(os.listdir(os.path.dirname(source))))
        move(s, source, target)

    monkeypatch.setattr(storage, "move", seen)
    rows = spark.range(10)
    run = replay.in_turns(spark, {"a": rows.schema, "b": rows.schema}, lambda a, b: a.unionByName(b), [{"a": rows, "b": rows}, {"a": rows}])
    assert waiting == [2, 1, 1] and run.out().count() == 30
