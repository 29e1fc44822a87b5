"""Hard negatives against plain Python over all pairs."""

import math
import subprocess
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from vigilake.llm import negatives, queries
from vigilake.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows, anchor, label=lambda i, x: x, positives=5, negatives=3):
    """rows: (id, vector, label), each id once."""
    kept = [(i, [math.floor(256 * x) for x in v], label(i, y)) for i, v, y in rows if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v, y in kept:
        if anchor(i):
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j, z) for j, w, z in kept)
            for p, j, _ in [s for s in scored if s[2] == y and s[1] != i][:positives]:
                fits = [s for s in scored if s[2] != y and -50 * p <= -100 * s[0] <= -95 * p][:negatives]
                out += [(i, j, rank, k, -p, -s) for rank, (s, k, _) in enumerate(fits, 1)]
    return sorted(out)


def run(spark, given_rows, anchor, schema=SCHEMA, label=None, **given):
    df = given_rows if not isinstance(given_rows, list) else spark.createDataFrame(given_rows, schema)
    return sorted(map(tuple, negatives.hard_negatives(negatives.whole_vectors(df, F.col("label") if label is None else label), anchor, **given).collect()))


def test_query(spark):
    rows = [tuple(r) for r in table(spark, SF, "embeddings").select("vec_id", "embedding", "label").collect()]
    want = expected(rows, lambda i: i % 50 == 0, lambda i, y: (y + 1) % 10 if i % 7 == 0 else y)
    assert want and sorted(map(tuple, queries.op13_hard_negatives(spark, SF).collect())) == want


@pytest.fixture(scope="module")
def mixed(spark):
    """One label has a third of the rows, many have one; equal vectors tie; vectors are of several lengths."""
    rows = []
    for i in range(160):
        label = 0 if i % 3 == 0 else i if i % 5 == 0 else i % 4
        rows.append((i, [float((i * k) % 7) / 4 - 0.5 for k in range(1, 4 + i % 4)] if i % 9 else [0.5, 0.25, 1.0], label))
    return rows


@pytest.mark.parametrize("blocks, chunk", [(7, 2), (1000, 3), (3, 100)])
def test_blocks_and_chunks(spark, mixed, blocks, chunk):
    want = expected(mixed, lambda i: i % 4 == 0)
    assert want and run(spark, mixed, F.col("id") % 4 == 0, rows=blocks, chunk=chunk) == want


def test_rows_that_take_no_part(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 1.0], 1), (1, [1.0, 0.5], 1), (2, [0.5, 0.5], 2), (3, None, 2), (4, [0.5, None], 2), (5, [nan, 1.0], 2), (6, [inf, 0.0], 2), (7, [0.5, 0.5], None), (None, [0.5, 0.5], 2), (8, [], 3), (50, [], 4)]
    assert run(spark, rows, F.col("id") % 50 == 0) == expected(rows, lambda i: i % 50 == 0) != []


def test_repeated_rows(spark):
    """Rows of one id are rows of their own: the copy is a positive, and both are anchors."""
    rows = [(0, [1.0], 1), (0, [1.0], 1), (1, [0.75], 2)]
    assert run(spark, rows, F.col("id") == 0) == [(0, 0, 1, 1, 65536, 49152)] * 2


def test_empty_strings_and_extra_columns(spark):
    assert run(spark, [], F.lit(True)) == [] and run(spark, [(1, [1.0], 1)], F.lit(True)) == [] and run(spark, [(1, [1.0], 1)], F.lit(False)) == []
    named = spark.createDataFrame([(0, [1.0, 0.0], "a", 1, "x"), (1, [1.0, 0.0], "a", 2, "y"), (2, [0.75, 0.0], "b", 3, "z")], "vec_id long, embedding array<double>, label string, rank int, id string")
    assert run(spark, named, F.col("id") == 0) == [(0, 1, 1, 2, 65536, 49152)]


def test_large_numbers(spark):
    """Sums beyond what floats hold exactly are exact; those beyond 64 bits are an error."""
    rows = [(0, [1e6, 3e6 + 1], 1), (1, [1e6, 3e6], 1), (2, [1e6 - 1, 2e6], 2)]
    schema = "vec_id long, embedding array<double>, label int"
    assert run(spark, rows, F.col("id") == 0, schema) == expected(rows, lambda i: i == 0) != []
    with pytest.raises(Exception, match="64 bits"):
        run(spark, [(i, [1e12], i % 2) for i in range(4)], F.col("id") == 0, schema)


def test_a_tile_is_added_in_a_fresh_worker(tmp_path):
    """A worker that has got a tile, but imported nothing beyond the module: pyarrow alone does not bring pyarrow.compute."""
    strips = {"nth": [0, None], "strip": [np.array([6], "<i2").tobytes(), None], "ids": [None, np.array([7]).tobytes()], "nths": [None, np.array([1]).tobytes()]}
    rest = {"names": pa.array([None, [5]], pa.list_(pa.int64())), "labels": pa.array([4, None], pa.int64()), "windows": pa.array([None, None], pa.list_(pa.int64())), "id": pa.array([9, None], pa.int64())}
    tile = pa.table(strips | rest)
    with pa.ipc.new_stream(str(tmp_path / "tile"), tile.schema) as out:
        out.write_table(tile)
    code = "import sys, pyarrow as pa; from vigilake.llm import negatives; print([x.tolist() for x in negatives._added(pa.ipc.open_stream(sys.argv[1]).read_all())[1:]])"
    done = subprocess.run([sys.executable, "-c", code, str(tmp_path / "tile")], capture_output=True, text=True, cwd=Path(__file__).parents[2])
    assert done.stdout.strip() == "[[[6]], [7], [1], [[False]]]", done.stderr
