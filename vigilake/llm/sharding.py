"""Sharding (operator 5): a two-pass external shuffle.

Pass 1 scatters records into buckets by a seeded hash of the whole record; there are as many buckets as it takes for
each to fit a task's memory, and as many as shards at least, so that small inputs spread over tasks too. Records that are
equal in everything, more than TIED of them, are numbered and scattered like others. Pass 2 shuffles each bucket by
Fisher-Yates, seeded by the bucket, cuts the buckets in their order into shards of equal row counts (at most one apart),
and writes them in parts, some buckets in a row each, so that a shard of any size is the work of many tasks. The order
depends on the seed and the records alone: a lost task gives the same rows again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from vigilake.llm.common import cleaning, materialize, number_ties, scratch_path

SHARDS = 40
BUCKET_BYTES = 4 << 20
ROW_BYTES = 16  # what a row counts besides its text
#: Buckets of a part, which one task writes, and tasks at most.
PART_BUCKETS, MAX_TASKS = 8, 100_000
#: Equal records that may share a bucket.
TIED = 100
#: Buckets whose starts are summed up in one place, and up to so many of which the table of starts (24 bytes each) is broadcast.
SUMMED, MAX_BROADCAST = 1 << 12, 1 << 18


def fisher_yates(n: int, seed: int) -> np.ndarray:
    """A permutation of 0 to n - 1."""
    order = np.arange(n)
    rng = np.random.Generator(np.random.PCG64(seed))
    for at, other in zip(range(n - 1, 0, -1), rng.integers(0, np.arange(n, 1, -1)).tolist()) if n > 1 else ():
        order[at], order[other] = order[other], order[at]
    return order


def _starts(counts: DataFrame, buckets: int) -> DataFrame:
    """__bucket, __start: the rows of all buckets before it. The driver sees a sum for each SUMMED buckets."""
    counts = materialize(counts.withColumn("__group", F.expr(f"__bucket div {SUMMED}")), "counts")
    sums = dict(counts.groupBy("__group").agg(F.sum("n")).collect())
    before = np.concatenate(([0], np.cumsum([sums.get(g, 0) for g in range(buckets // SUMMED + 1)]))).tolist()
    inside = F.coalesce(F.sum("n").over(W.partitionBy("__group").orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return counts.select("__bucket", (F.get(F.lit(before[:-1]), F.col("__group").cast("int")) + inside).alias("__start"))


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = 5, text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All rows and columns of docs with size (long), shard (int, from 0), slot (long, gapless from 0 in its shard) and part (long).

    size is the text's UTF-8 bytes (null: none) plus 16. Null and repeated ids are scattered by the rest of their record.
    Equal records are alike in what decides here, so any order among them is the same result. A part holds consecutive
    slots of each shard that it has rows of. With fewer rows than shards, some shards stay empty. Columns named size,
    shard, slot or part are replaced."""
    rows = docs.drop("size", "shard", "slot", "part").withColumn("size", F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + ROW_BYTES)
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).first()
    total_rows, names = total.n, rows.columns
    buckets = max(shards, -(-(total.bytes or 0) // bucket_bytes))
    rows = number_ties(rows, more_than=TIED)
    rows = rows.withColumn("__bucket", F.pmod(F.xxhash64(F.lit(seed), "__key", "__nth"), F.lit(buckets)))
    first = _starts(rows.groupBy("__bucket").agg(F.count(F.lit(1)).alias("n")), buckets)
    dealt = rows.join(F.broadcast(first) if buckets <= MAX_BROADCAST else first, "__bucket")
    dealt = dealt.withColumn("part", F.expr(f"__bucket div {PART_BUCKETS}"))

    def shuffled(t: pa.Table) -> pa.Table:
        t = t.sort_by([("__key", "ascending"), ("__nth", "ascending")])
        place = fisher_yates(t.num_rows, seed * 1_000_003 + t.column("__bucket")[0].as_py())
        at = t.column("__start")[0].as_py() + place
        # Shard s takes positions from ceil(s * N / S) up to that of the next.
        to = at * shards // total_rows
        slot = at + (-to * total_rows) // shards
        return t.select(names).append_column("shard", pa.array(to.astype(np.int32))).append_column("slot", pa.array(slot)).append_column("part", t.column("part"))

    schema = docs.sparkSession.createDataFrame([], dealt.select(*names).schema).withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long"), "part": F.lit(0).cast("long")}).schema
    # One shuffle brings a part together, and so each of its buckets: a task for each part, or for some parts in a row.
    tasks = min(-(-buckets // PART_BUCKETS), MAX_TASKS)
    return dealt.repartitionByRange(tasks, "part").groupBy("part", "__bucket").applyInArrow(shuffled, schema)


def write_shards(sharded: DataFrame, path: str) -> DataFrame:
    """Writes {path}/shard=S/part=P: a Parquet file of consecutive slots, in order, for each part of a shard; gives all of them read back."""
    with cleaning(sharded.sparkSession):
        sharded.sortWithinPartitions("shard", "part", "slot").write.partitionBy("shard", "part").option("compression", "zstd").parquet(path)
    return sharded.sparkSession.read.schema(sharded.schema).parquet(path)


def layout(sharded: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of what shard() gives."""
    return sharded.select(F.col(id_col).alias("doc_id"), "size", F.crc32(F.encode(F.coalesce(text_col, F.lit("")), "UTF-8")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def shard_and_read(docs: DataFrame, shards: int = SHARDS, text_col: str = "text") -> DataFrame:
    """layout() of what stands in the files that write_shards() makes of docs, in the scratch folder."""
    return layout(write_shards(shard(docs, shards, text_col=text_col), scratch_path(docs.sparkSession, "shards")), text_col=text_col)
