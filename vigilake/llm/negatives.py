"""Hard-negative mining (operator 13): a block matrix multiply in two dimensions (SUMMA), over rows and over chunks of dimensions.

Vectors become whole numbers, are sorted by label and numbered; ROWS consecutive ones are a block, whatever the sizes of
labels. A tile is a block of anchors against a block of rows. Both blocks' parts of each chunk of dimensions meet in a task of
their own and give a partial tile of int64 scores; a second shuffle brings a tile's parts together, adds them, and only the best
of the tile go on. It is done twice, for different pairs: first rows meet anchors of their label only, which gives each anchor's
positives; then anchors bring the score windows of their positives to all tiles, whose rows of other labels are judged. So no
tile is ever stored, and no pair of rows leaves a task but those that lead their tile."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vigilake.llm.common import materialize, numbered

#: Rows of a block, on either side, and dimensions of a chunk.
ROWS, CHUNK = 1024, 32
POSITIVES, NEGATIVES, LOW, HIGH = 5, 3, 50, 95
SCALE = 256
#: Products of floats are exact below this.
EXACT = 1 << 53
_NONE = np.iinfo(np.int64).min


def whole_vectors(embeddings: DataFrame, label: Column, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, label, x: rows that take part, their components as floor(SCALE * x). Rows without id, label or vector, or with a null or non-finite component, take no part."""
    rows = embeddings.select(F.col(id_col).cast("long").alias("id"), label.alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    return rows.select("id", "label", F.transform("v", lambda x: F.floor(x * SCALE).cast("long")).alias("x"))


def _matrix(table: pa.Table, chunk: int) -> np.ndarray:
    """The rows' parts as a matrix of `chunk` columns; shorter ones end in zeros."""
    parts = table.column("x").combine_chunks()
    lengths = np.diff(parts.offsets.to_numpy())
    out = np.zeros((len(parts), chunk), np.int64)
    out[np.arange(chunk) < lengths[:, None]] = parts.flatten().to_numpy(zero_copy_only=False)
    return out


def _largest(m: np.ndarray) -> int:
    return max(int(m.max()), -int(m.min())) if m.size else 0


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a times b transposed, exact; an error where a sum might not fit in 64 bits."""
    most = sum(int(x) * int(y) for x, y in zip(*(np.maximum(m.max(axis=0), -m.min(axis=0)) for m in (a, b))))
    if most < EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if most >> 63:
        raise OverflowError("scores do not fit in 64 bits")
    return a @ b.T


def _narrow(strip: np.ndarray) -> bytes:
    """A row of a tile as whole numbers of two, four or eight bytes; how many follows from the length."""
    most = max(int(strip.max()), -int(strip.min()))
    return strip.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8").tobytes()


def _wide(strip: bytes, n: int) -> np.ndarray:
    return np.frombuffer(strip, {2: "<i2", 4: "<i4", 8: "<i8"}[len(strip) // n]).astype(np.int64)


def _multiplier(chunk: int):
    """Of a chunk: a strip of partial scores for each anchor, and one row (no strip) that names the block's columns."""

    def multiply(key, anchors: pa.Table, rows: pa.Table) -> pa.Table:
        i, j, k = (x.as_py() for x in key)
        schema = pa.schema([("i", pa.int64()), ("j", pa.int64()), ("nth", pa.int64()), ("strip", pa.binary()), ("ids", pa.binary()), ("labels", rows.schema.field("label").type), ("names", pa.list_(rows.schema.field("label").type)), ("nths", pa.binary()), ("windows", anchors.schema.field("windows").type), ("id", pa.int64())])
        if not len(anchors) or not len(rows):
            return schema.empty_table()
        rows, anchors = rows.sort_by([("id", "ascending"), ("nth", "ascending")]), anchors.sort_by("nth")
        partial = _product(_matrix(anchors, chunk), _matrix(rows, chunk))
        n = len(anchors)
        out = {"i": [i] * n, "j": [j] * n, "nth": anchors.column("nth").combine_chunks(), "strip": pa.array([_narrow(s) for s in partial], pa.binary())}
        none = lambda kind: pa.nulls(n, kind)
        first = k == 0
        out |= {"ids": none(pa.binary()), "names": none(schema.field("names").type), "nths": none(pa.binary())}
        out |= {"labels": anchors.column("label").combine_chunks() if first else none(schema.field("labels").type), "windows": anchors.column("windows").combine_chunks() if first else none(schema.field("windows").type), "id": anchors.column("id").combine_chunks() if first else none(pa.int64())}
        strips = pa.table([pa.array(out[f.name], f.type) if isinstance(out[f.name], list) else out[f.name] for f in schema], schema=schema)
        if not first:
            return strips
        header = {"i": [i], "j": [j], "ids": [rows.column("id").to_numpy().tobytes()], "names": [rows.column("label").to_pylist()], "nths": [rows.column("nth").to_numpy().tobytes()]}
        return pa.concat_tables([strips, pa.table([pa.array(header.get(f.name, [None]), f.type) for f in schema], schema=schema)])

    return multiply


def _added(table: pa.Table) -> tuple[list[dict], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A tile: its anchors, int64 scores, the columns' ids and numbers, and where anchor and column share the label."""
    head = next(r for r in table.filter(pc.is_valid(table.column("ids"))).to_pylist())
    ids, nths = np.frombuffer(head["ids"], np.int64), np.frombuffer(head["nths"], np.int64)
    anchors = sorted(table.filter(pc.is_valid(table.column("id"))).drop(["strip", "ids", "names", "nths"]).to_pylist(), key=lambda r: r["nth"])
    at = {r["nth"]: k for k, r in enumerate(anchors)}
    scores = np.zeros((len(anchors), len(ids)), np.int64)
    strips = table.filter(pc.is_valid(table.column("strip")))
    largest = 0
    for nth, strip in zip(strips.column("nth").to_pylist(), strips.column("strip")):
        part = _wide(strip.as_py(), len(ids))
        largest = max(largest, _largest(part))
        scores[at[nth]] += part
    if largest * (len(strips) // max(1, len(anchors)) + 1) >> 63:
        raise OverflowError("scores do not fit in 64 bits")
    names: dict = {}
    code = lambda values: np.array([names.setdefault(v, len(names)) for v in values])
    same = code([r["labels"] for r in anchors])[:, None] == code(head["names"])[None, :]
    return anchors, scores, ids, nths, same


def _best(scores: np.ndarray, able: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, columns) of the best able score of each row, then of the second best and so on; of equal ones the first."""
    left, able = np.where(able, scores, _NONE), able.copy()
    line = np.arange(len(scores))
    for _ in range(n):
        column = left.argmax(axis=1)
        found = np.flatnonzero(able[line, column])
        if not len(found):
            return
        yield found, column[found]
        left[found, column[found]], able[found, column[found]] = _NONE, False


def _positives(n: int):
    def reduce(table: pa.Table) -> pa.Table:
        anchors, scores, ids, nths, same = _added(table)
        able = same & (nths[None, :] != np.array([r["nth"] for r in anchors])[:, None])
        out = [(anchors[r]["nth"], int(nths[c]), int(ids[c]), int(scores[r, c])) for rows, columns in _best(scores, able, n) for r, c in zip(rows, columns)]
        return pa.table([pa.array(x, pa.int64()) for x in (list(zip(*out)) or [[]] * 4)], ["nth", "pos_nth", "pos_id", "pos_score"])

    return reduce


def _negatives(n: int):
    def reduce(table: pa.Table) -> pa.Table:
        anchors, scores, ids, nths, same = _added(table)
        out = []
        for k in range(max((len(r["windows"]) for r in anchors), default=0)):
            has = [r for r, a in enumerate(anchors) if len(a["windows"]) > k]
            windows = [anchors[r]["windows"][k] for r in has]
            own = scores[has]
            lo, hi = (np.array([w[x] for w in windows])[:, None] for x in ("lo", "hi"))
            for rows, columns in _best(own, ~same[has] & (own >= lo) & (own <= hi), n):
                out += [(anchors[has[r]]["nth"], anchors[has[r]]["id"], windows[r]["pos_nth"], windows[r]["pos_id"], windows[r]["pos_score"], int(nths[c]), int(ids[c]), int(own[r, c])) for r, c in zip(rows, columns)]
        names = ["nth", "anchor_id", "pos_nth", "positive_id", "positive_score", "neg_nth", "negative_id", "negative_score"]
        return pa.table([pa.array(x, pa.int64()) for x in (list(zip(*out)) or [[]] * 8)], names)

    return reduce


def _chunks(rows: DataFrame, n_chunks: int, chunk: int) -> DataFrame:
    """A row for each chunk k of dimensions, with that part of x (maybe empty)."""
    return rows.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1)))).withColumn("x", F.slice("x", F.col("k") * chunk + 1, F.lit(chunk)))


def _tiles(anchors: DataFrame, rows: DataFrame, chunk: int, label_type: str, reduce, schema: str) -> DataFrame:
    """anchors and rows, dealt to tiles i, j and chunks k: multiplied, added, reduced."""
    windows = "array<struct<pos_nth:bigint,pos_id:bigint,pos_score:bigint,lo:bigint,hi:bigint>>"
    strip = f"i long, j long, nth long, strip binary, ids binary, labels {label_type}, names array<{label_type}>, nths binary, windows {windows}, id long"
    partial = anchors.groupBy("i", "j", "k").cogroup(rows.groupBy("i", "j", "k")).applyInArrow(_multiplier(chunk), strip)
    return partial.groupBy("i", "j").applyInArrow(reduce, schema)


def _leaders(found: DataFrame, keys: list[str], score: str, id_col: str, nth: str, n: int, rank: str) -> DataFrame:
    """The best n of each key over all tiles, which give n each at most."""
    w = W.partitionBy(*keys).orderBy(F.col(score).desc(), id_col, nth)
    return found.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, rows: int = ROWS, chunk: int = CHUNK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    vectors: id, label, x of whole_vectors(). Scores are inner products, which must fit in 64 bits (else an error); higher
    ones come first, ties by the smaller id, and then as rows are numbered. An anchor's positives are the first `positives`
    other rows of its label, and its negatives for one of them the first `negatives` rows of other labels with low %
    to high % of the positive's score. Rows that share an id are rows of their own: as anchors they give their rows each, and
    each may be the other's positive. Vectors may differ in length: what is missing counts as 0. No anchor, no positive or
    no row within the window: no row."""
    label_type = vectors.schema["label"].dataType.simpleString()
    every = numbered(vectors, "nth", F.col("label"), F.col("id"))
    every = materialize(every.withColumn("anchor", anchor), "vectors")
    sizes = every.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d"), F.count(F.when(F.col("anchor"), 1)).alias("a")).first()
    n_chunks = max(1, -(-(sizes.d or 0) // chunk))
    i_blocks, j_blocks = max(1, -(-sizes.a // rows)), max(1, -(-sizes.n // rows))
    chosen = numbered(every.filter("anchor"), "place", F.col("nth"))
    chosen = chosen.select("id", "label", "x", "nth", F.expr(f"place div {rows}").alias("i"))
    chosen = materialize(chosen, "anchors")
    columns = every.select("id", "label", "x", "nth", F.expr(f"nth div {rows}").alias("j"))

    # Rows are in order of label, so a label's rows are in consecutive blocks.
    of_rows = columns.groupBy("label").agg(F.min("j").alias("j0"), F.max("j").alias("j1"))
    of_anchors = chosen.groupBy("label").agg(F.min("i").alias("i0"), F.max("i").alias("i1"))
    none = F.lit(None).cast("array<struct<pos_nth:bigint,pos_id:bigint,pos_score:bigint,lo:bigint,hi:bigint>>").alias("windows")
    own = chosen.join(of_rows, "label").select("id", "label", "x", "nth", "i", F.explode(F.sequence("j0", "j1")).alias("j"), none)
    theirs = columns.join(of_anchors, "label").select("id", "label", "x", "nth", "j", F.explode(F.sequence("i0", "i1")).alias("i"))
    found = _tiles(_chunks(own, n_chunks, chunk), _chunks(theirs, n_chunks, chunk), chunk, label_type, _positives(positives), "nth long, pos_nth long, pos_id long, pos_score long")
    best = _leaders(found, ["nth"], "pos_score", "pos_id", "pos_nth", positives, "r")
    score = F.col("pos_score").cast("decimal(38,0)")
    lo, hi = F.ceil(score * low / 100).cast("long"), F.floor(score * high / 100).cast("long")
    windows = best.groupBy("nth").agg(F.collect_list(F.struct("pos_nth", "pos_id", "pos_score", lo.alias("lo"), hi.alias("hi"))).alias("windows"))  # `positives` at most
    windows = materialize(windows, "windows")

    own = chosen.join(windows, "nth").select("id", "label", "x", "nth", "i", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(j_blocks - 1).cast("long"))).alias("j"), "windows")
    theirs = columns.select("id", "label", "x", "nth", "j", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(i_blocks - 1).cast("long"))).alias("i"))
    schema = "nth long, anchor_id long, pos_nth long, positive_id long, positive_score long, neg_nth long, negative_id long, negative_score long"
    found = _tiles(_chunks(own, n_chunks, chunk), _chunks(theirs, n_chunks, chunk), chunk, label_type, _negatives(negatives), schema)
    out = _leaders(found, ["nth", "pos_nth"], "negative_score", "negative_id", "neg_nth", negatives, "rank")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
