"""Schemas that are inferred, logged and extended."""

import json

from pyspark.sql import types as T

from vigilake.sources.evolving import EvolvingTable, SchemaLog, infer


def put(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))


def test_infer(spark):
    lines = ['{"b": 1, "a": "x", "d": 1.5, "o": {"k": 1, "l": [1]}}', '{"b": 2.0, "n": null, "d": 2, "c": true}', "no json", "[1]", None]
    got = infer(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert {f.name: f.dataType.simpleString() for f in got.fields} == {"a": "string", "b": "double" if got["b"].dataType == T.DoubleType() else "bigint", "c": "boolean", "d": "double", "n": "string", "o": "struct<k:bigint,l:array<bigint>>"}
    assert infer(spark.createDataFrame([("no",), (None,)], "value string")) == T.StructType()
    assert infer(spark.createDataFrame([], "value string")) == T.StructType()


def test_log(spark, tmp_path):
    log = SchemaLog(str(tmp_path / "log"))
    assert log.current(spark) == (0, None)
    one, two = T.StructType().add("a", "integer"), T.StructType().add("a", "integer").add("b", "string")
    assert log.add(spark, 1, one) and log.add(spark, 2, two) and not log.add(spark, 2, one)
    assert log.current(spark) == (2, two)


def test_fields_turn_up(spark, tmp_path):
    source, table = tmp_path / "in", EvolvingTable(spark, str(tmp_path / "in"), str(tmp_path / "table"))
    put(source, "1.json", {"k": 1, "name": "x"})
    assert table.take() == 0 and table.log.versions(spark) == [1]
    put(source, "2.json", {"k": 2, "tag": True}, {"k": "two"}, "broken")
    assert table.take() == 1 and table.log.versions(spark) == [1, 2]
    again = EvolvingTable(spark, str(source), str(tmp_path / "table"))
    put(source, "3.json", {"k": 3, "tag": False, "name": "z"}, {"k": 4, "tag": "no"})
    assert again.take() == 0
    rows = sorted((r.k, r.name, r.tag, r._rescued_data) for r in again.read().filter("k IS NOT NULL").collect())
    assert rows == [(1, "x", None, None), (2, None, None, '{"tag":"true"}'), (3, "z", False, None), (4, None, None, '{"tag":"no"}')]
    rest = sorted(r._rescued_data for r in again.read().filter("k IS NULL").collect())
    assert rest == ['{"_corrupt_record":"broken"}', '{"k":"two"}']


def test_many_files_at_once(spark, tmp_path):
    """Fields turn up twice while one call takes all files, one at a time; every row is there once."""
    source = tmp_path / "in"
    for i in range(6):
        put(source, f"{i}.json", {"k": i} | ({"a": i} if i >= 2 else {}) | ({"b": i} if i >= 4 else {}))
    table = EvolvingTable(spark, str(source), str(tmp_path / "table"), T.StructType().add("k", "long"))
    assert table.take(files_per_trigger=1) >= 1
    assert sorted(r.k for r in table.read().collect()) == list(range(6))
    assert set(table.log.current(spark)[1].names) == {"k", "a", "b"}
    assert EvolvingTable(spark, str(tmp_path / "none"), str(tmp_path / "t2")).take() == 0
