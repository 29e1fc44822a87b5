"""SimHash near-duplicates (operator 2): pigeonhole blocks, a join on blocks, then the Hamming distance.

Fingerprints are made by a map over whole texts. From then on only distinct fingerprints count, one row
for each class of equal ones. 64 bits are split into blocks; two fingerprints that differ in at most D bits agree
in all but D blocks, so each choice of blocks without D of them is a join key. There are as many blocks as it takes
for chance alone to put few fingerprints in a bucket: keys have more bits where there are more fingerprints.

In a bucket of few fingerprints all are compared, a pair at the first choice it agrees on and at no other. Near copies
by the thousand share keys, so in a crowded bucket all are compared with the least one first. What is then connected
needs no more comparing: those outside the largest connected part of the bucket, if they are few, are compared with
all of it; if they are not, the bucket's fingerprints go on to more and smaller blocks, hence longer keys, and so on. A
pair that is close shares a bucket at each depth, so none is lost; at the last depth fingerprints of a bucket have 48
of 64 bits in common. Comparisons grow with fingerprints, not with the pairs of a crowd.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilake.llm.common import materialize
from vigilake.llm.graph import components

SHINGLE, MAX_BITS = 4, 4
#: Blocks at each depth, beyond the bits in which fingerprints may differ.
SPARE = (1, 2, 3, 4, 5, 6, 8, 12)
#: Fingerprints of a bucket that are compared with all of it.
FEW = 48
SEED = 42
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def shingle_hashes(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of `size` words (one of all words, if there are fewer); null or without words: none."""
    from xxhash import xxh64_intdigest

    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space
    if not found:
        return np.empty(0, np.uint64)
    flat = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(size, len(found))
    cuts = zip(starts[: len(found) - k + 1].tolist(), ends[k - 1 :].tolist())
    return np.fromiter((xxh64_intdigest(flat[a:b], SEED) for a, b in cuts), np.uint64, len(found) - k + 1)


def fingerprint(text: str | None) -> int:
    """64-bit SimHash (unsigned) of one text; null or without words: 0."""
    hashes = shingle_hashes(text)
    if not len(hashes):
        return 0
    lanes = hashes.view(np.uint8).reshape(-1, 8)
    set_bits = np.concatenate([np.bincount(lanes[:, i], minlength=256) @ _BITS for i in range(8)])
    return int(np.packbits(set_bits * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (long: the fingerprint's bits), for each row of docs; other columns are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py()) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _keys(bits: int, blocks: int) -> list[tuple[int, list[int]]]:
    """For each choice of blocks - bits blocks: its mask, and the masks of earlier blocks that it leaves out."""
    edge = [64 * i // blocks for i in range(blocks + 1)]
    mask = [((1 << edge[i + 1]) - 1) ^ ((1 << edge[i]) - 1) for i in range(blocks)]
    return [(sum(mask[i] for i in c), [mask[i] for i in range(c[-1]) if i not in c]) for c in combinations(range(blocks), blocks - bits)]


def _close(bits: int) -> str:
    return f"bit_count(a.fp ^ b.fp) <= {bits}"


def _buckets(fps: DataFrame, keys: list[tuple[int, list[int]]]) -> DataFrame:
    """k, bucket, fp, least, n: fingerprints in buckets of two at least, with the bucket's least one and their number."""
    choices = [F.struct(F.lit(i).cast("smallint").alias("k"), F.col("fp").bitwiseAND(_signed(m)).alias("bucket")) for i, (m, _) in enumerate(keys)]
    dealt = fps.select("fp", F.inline(F.array(*choices)))
    shared = materialize(dealt.groupBy("k", "bucket").agg(F.min("fp").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "shared")
    return materialize(dealt.join(shared, ["k", "bucket"]), "buckets")


def links(fps: DataFrame, bits: int = MAX_BITS, few: int = FEW, start: int | None = None) -> DataFrame:
    """a, b: links enough to connect all distinct values of fps.fp (long) that differ in at most `bits` bits.

    start: the first depth; None: by the number of values."""
    fps = fps.select("fp")
    if start is None:
        n = fps.count()
        start = next((i for i, s in enumerate(SPARE) if 4 << 64 * s // (s + bits) >= n), len(SPARE) - 1)
    found: list[DataFrame] = []
    for depth, spare in list(enumerate(SPARE))[start:]:
        keys = _keys(bits, bits + spare)
        rows = _buckets(fps, keys)
        first = "CASE a.k " + " ".join(f"WHEN {i} THEN " + " AND ".join(["true", *(f"(a.fp ^ b.fp) & {_signed(m)}L <> 0" for m in out)]) for i, (_, out) in enumerate(keys)) + " END"
        small, crowd = rows.filter(F.col("n") <= few), rows.filter(F.col("n") > few)
        pairs = small.alias("a").join(small.alias("b"), F.expr(f"a.k = b.k AND a.bucket = b.bucket AND a.fp < b.fp AND {_close(bits)} AND {first}")).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
        star = crowd.filter(f"fp <> least AND bit_count(fp ^ least) <= {bits}").select(F.col("least").alias("a"), F.col("fp").alias("b")).distinct()
        found.append(materialize(pairs.unionByName(star), "pairs"))
        if not crowd.take(1):
            break
        roots = materialize(components(reduce(DataFrame.unionByName, found)), "roots")
        named = crowd.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("k", "bucket", "fp", F.coalesce("root", "fp").alias("root"), "n")
        named = materialize(named, "crowd")
        main = named.groupBy("k", "bucket", "root").agg(F.count(F.lit(1)).alias("own"), F.first("n").alias("n")).groupBy("k", "bucket").agg(F.max(F.struct("own", "root")).alias("main"), F.first("n").alias("n"))
        main = materialize(main.select("k", "bucket", F.col("main.root").alias("main"), (F.col("n") - F.col("main.own")).alias("others")).filter("others > 0"), "main")
        last = depth == len(SPARE) - 1
        rest = materialize(named.join(main.filter(F.col("others") <= few) if not last else main, ["k", "bucket"]), "rest")
        meet = rest.filter("root <> main").alias("a").join(rest.alias("b"), F.expr(f"a.k = b.k AND a.bucket = b.bucket AND a.root <> b.root AND {_close(bits)}"))
        found.append(materialize(meet.select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")).distinct(), "pairs"))
        if last:
            break
        fps = materialize(named.join(main.filter(F.col("others") > few), ["k", "bucket"]).select("fp").distinct(), "crowded")
        if not fps.take(1):
            break
    return reduce(DataFrame.unionByName, found)


def name_components(rows: DataFrame, linked: DataFrame) -> DataFrame:
    """doc_id, fp, component_id of rows (doc_id, fp), whose fingerprints are linked (a, b).

    A class of equal fingerprints may hold any share of the rows, and a component any share of the classes: each is one
    row from its first aggregate on, and meets its rows again in a join whose large side Spark may split."""
    classes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = materialize(components(linked), "roots")
    named = materialize(roots.withColumnRenamed("node", "fp").join(classes, "fp"), "named")
    least = materialize(named.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    named = materialize(named.join(least, "root").select("fp", "component_id"), "named")
    named = classes.join(named, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    return rows.select("doc_id", "fp").join(materialize(named, "named"), "fp").select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp (long), component_id (least doc_id that links reach), for each row of docs.

    Documents link if their fingerprints differ in at most `bits` bits; equal ones always do. Null and empty
    texts have fingerprint 0 and link like any other. Repeated rows stay; a null doc_id is linked but names no
    component unless all of one are null."""
    fps = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    return name_components(fps, links(fps.select("fp").distinct(), bits))


def keep_representatives(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of docs without those that near_duplicates() gives another document for; rows with a null id stay."""
    others = groups.filter("doc_id <> component_id").select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(others, id_col, "left_anti").select(*docs.columns)
