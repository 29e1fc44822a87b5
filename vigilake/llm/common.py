"""What the training-data operators share: word rules, scratch tables, table access."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java regex of a run of white space; words are what stands between such runs.
SPACE = "[\\x20\\x09-\\x0D]+"
#: The same characters, for translate().
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text as an array; null or blank text: empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def scratch_dir(spark: SparkSession) -> str:
    """A folder of this application below spark.checkpoint.dir, which all executors share.

    Only where one machine does all the work (a local master) may the setting be missing; then a temporary folder is set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = f"{tempfile.gettempdir()}/vigilake-checkpoints"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/vigilake/{spark.sparkContext.applicationId}"


_made: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the scratch folder, removed when the driver ends."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


@atexit.register
def _clean() -> None:
    for spark, path in _made:
        if spark.sparkContext._jsc is not None:
            drop_path(spark, path)


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


#: Rows that number_ties() makes in one place.
BLOCK = 10_000
#: Spark then removes the shuffle files of a query as soon as it has ended.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def cleaning(spark: SparkSession) -> Iterator[None]:
    """For a write after which nothing needs what was shuffled for it."""
    before = spark.conf.get(CLEAN, None)
    spark.conf.set(CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEAN) if before is None else spark.conf.set(CLEAN, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: writes df to the shared scratch folder and reads it back.

    The written table outlives any executor, so later reads never recompute what led to it."""
    path = scratch_path(df.sparkSession, name)
    with cleaning(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def made_since(number: int) -> list[tuple[SparkSession, str]]:
    """Scratch paths made after the first `number` ones."""
    return _made[number:]


def drop(*tables: DataFrame) -> None:
    """Removes tables that materialize() gave, once nothing reads them any more."""
    for t in tables:
        drop_path(t.sparkSession, t.scratch)


def row_key(rows: DataFrame) -> Column:
    """A hash of all of a row's columns (of maps: of their entries in order)."""
    return F.xxhash64(*[F.sort_array(F.map_entries(f"`{c}`")) if kind.startswith("map") else F.col(f"`{c}`") for c, kind in rows.dtypes])


def number_ties(rows: DataFrame, key: str = "__key", nth: str = "__nth", more_than: int = 1) -> DataFrame:
    """rows with key (row_key()) and nth (long): 0, 1, ... for rows that are equal in all columns, where there are more than `more_than` of them; else 0.

    Equal rows are counted before any shuffle and then made again from their number, BLOCK at a time, so that one row that
    is there a billion times is spread over tasks. Which of the equal rows has which number means nothing."""
    names, keyed = rows.columns, rows.withColumn(key, row_key(rows))
    ties = materialize(keyed.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > more_than).select(key), "ties")
    if not ties.take(1):
        return keyed.withColumn(nth, F.lit(0).cast("long"))
    flat = [F.sort_array(F.map_entries(f"`{c}`")).alias(c) if kind.startswith("map") else F.col(f"`{c}`") for c, kind in rows.dtypes]
    counted = keyed.join(ties, key, "left_semi").select(*flat, key).groupBy(*[f"`{c}`" for c in names], key).agg(F.count(F.lit(1)).alias("__n"))
    blocks = counted.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(__n - 1) div {BLOCK}")))).repartition(key, "__block")
    made = blocks.withColumn(nth, F.explode(F.sequence(F.col("__block") * BLOCK, F.least(F.col("__n"), (F.col("__block") + 1) * BLOCK) - 1)))
    back = [F.map_from_entries(f"`{c}`").alias(c) if kind.startswith("map") else F.col(f"`{c}`") for c, kind in rows.dtypes]
    return keyed.join(ties, key, "left_anti").select(*names, key, F.lit(0).cast("long").alias(nth)).unionByName(made.select(*back, key, nth))


def numbered(rows: DataFrame, nth: str, *order: Column) -> DataFrame:
    """rows with nth (long): 0, 1, ... in this order over all rows; rows that the order leaves equal are numbered as they come.

    Rows are sorted by ranges and written once; the counts of the ranges, a row each, give where each one begins."""
    sort = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    low = (1 << 33) - 1  # Spark's numbers are 2^33 times the partition's and from there on one by one
    place = F.monotonically_increasing_id()
    kept = materialize(sort.select("*", F.shiftright(place, 33).alias("__range"), place.bitwiseAND(low).alias("__at")), "sorted")
    begin, starts = 0, []
    for r in kept.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).orderBy("__range").collect():
        starts.append((r["__range"], begin))
        begin += r.n
    first = F.broadcast(rows.sparkSession.createDataFrame(starts, "__range long, __begin long"))  # as many rows as the sort has partitions
    return kept.join(first, "__range").withColumn(nth, F.col("__begin") + F.col("__at")).drop("__range", "__at", "__begin")
