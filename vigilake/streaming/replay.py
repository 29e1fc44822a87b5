"""Running a streaming plan over tables as they stand, at once or in turns."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from vigilake import storage
from vigilake.session import scratch_path

PARTS = "spark.sql.shuffle.partitions"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


#: Tasks that look up a batch's files, where there are more than a few.
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting for what is done inside."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: Tasks, and parts of a stream's state, that a core gets.
PARTS_A_CORE = 2


def few_parts(spark: SparkSession):
    """For streams that start inside: state in a few parts a core, where the session would have it in more.

    Each part is a store that is opened and committed in each micro-batch whether it has rows or not. The number is kept with the
    checkpoint from the first batch on; parts grow with the rows a core has."""
    given = int(spark.conf.get(PARTS))
    return _set(spark, PARTS, str(min(given, PARTS_A_CORE * spark.sparkContext.defaultParallelism)))


@contextmanager
def as_batch(spark: SparkSession, parts: str) -> Iterator[None]:
    """For what a micro-batch does inside, in its stream's session, without state: shuffles have so many parts and are adaptive."""
    with _set(spark, PARTS, parts), _set(spark, "spark.sql.adaptive.enabled", "true"):
        yield


def rocksdb(spark: SparkSession):
    """For queries that start inside: state that may be larger than memory, and that has timers and lists."""
    return _set(spark, PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


#: Files that a task keeps open at once; where there are as many as folders, rows needn't be sorted by folder.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def writers(spark: SparkSession, folders: int):
    """For rows that are written to so many folders inside: they aren't sorted by folder."""
    return _set(spark, WRITERS, str(folders + 1))


def staged(rows: DataFrame, turn: Column, turns: int) -> list[str]:
    """Folders with the rows of each turn, for Replay.arrive(): all are made in one pass over rows. turn: a row's turn, from 0, or explode() of several."""
    spark, root = rows.sparkSession, scratch_path(rows.sparkSession, "turns")
    with writers(spark, turns):
        rows.withColumn("__turn", turn).write.partitionBy("__turn").parquet(root)
    folders = [f"{root}/__turn={k}" for k in range(turns)]
    for f in folders:
        storage.make_folder(spark, f)
    return folders


Write = Callable[[DataFrame, int], None]


class Replay:
    """A streaming plan that gets its inputs turn by turn; each turn is one micro-batch (and one without data, where the watermark moves on).

    The rows of a turn come into view at once, in as many files as they have partitions."""

    def __init__(self, spark: SparkSession, schemas: dict[str, T.StructType], plan: Callable[..., DataFrame], mode: str = "append", write: Write | None = None, name: str | None = None):
        self.spark, self.schemas, self.plan, self.mode, self.write, self.name = spark, schemas, plan, mode, write, name
        self.root = scratch_path(spark, "replay")
        self.checkpoint = f"{self.root}/checkpoint"
        for n in schemas:
            storage.make_folder(spark, f"{self.root}/in/{n}")
        self.query: StreamingQuery | None = None
        self.frame: DataFrame | None = None

    def start(self) -> None:
        self.frame = self.plan(*[self.spark.readStream.schema(s).option("recursiveFileLookup", True).parquet(f"{self.root}/in/{n}") for n, s in self.schemas.items()])
        writer = self.frame.writeStream.outputMode(self.mode).option("checkpointLocation", self.checkpoint).trigger(processingTime="0 seconds")
        writer = writer.queryName(self.name) if self.name else writer
        writer = writer.foreachBatch(self.write) if self.write else writer.format("parquet").option("path", f"{self.root}/out")
        with few_parts(self.spark):
            self.query = writer.start()

    def arrive(self, turn: dict[str, DataFrame | str]) -> None:
        """Rows of some inputs (or folders of staged()) come in, when all of them are written; the query takes them, if it runs."""
        ready = {n: rows if isinstance(rows, str) else f"{self.root}/arriving/{uuid.uuid4().hex}" for n, rows in turn.items()}
        for n, rows in turn.items():
            if not isinstance(rows, str):
                rows.write.parquet(ready[n])
        for n, path in ready.items():
            storage.move(self.spark, path, f"{self.root}/in/{n}/{uuid.uuid4().hex}")
        if self.query and self.query.isActive:
            self.query.processAllAvailable()

    def stop(self) -> None:
        if self.query:
            self.query.stop()

    def restart(self) -> None:
        """Offsets, state and watermark go on from the checkpoint."""
        self.stop()
        self.start()

    def out(self) -> DataFrame:
        """What the plan has appended."""
        return self.spark.read.schema(self.frame.schema).parquet(f"{self.root}/out")


def in_turns(spark: SparkSession, schemas: dict[str, T.StructType], plan: Callable[..., DataFrame], turns: Iterable[dict[str, DataFrame | str]], stops: tuple[int, ...] = (), **given) -> Replay:
    """The plan over all turns, one after the other; it is stopped and started again after those of the numbers in stops (from 1)."""
    run = Replay(spark, schemas, plan, **given)
    run.start()
    for k, turn in enumerate(turns, 1):
        run.arrive(turn)
        if k in stops:
            run.restart()
    run.stop()
    return run


def drain(spark: SparkSession, tables: dict[str, DataFrame], plan: Callable[..., DataFrame], mode: str = "append", slices: dict[str, list[str]] | None = None, stops: tuple[int, ...] = ()) -> DataFrame:
    """What the plan appends over the whole tables, taken at once, or in turns.

    slices: for a table, conditions; the rows of each come in a turn of their own, in that order. stops: as for in_turns()."""
    slices = slices or {}
    most = max(map(len, slices.values()), default=1)
    turns = [{n: df.filter(slices[n][k]) if n in slices else df for n, df in tables.items() if k < len(slices.get(n, [0]))} for k in range(most)]
    return in_turns(spark, {n: df.schema for n, df in tables.items()}, plan, turns, stops, mode=mode).out()


def to_table(spark: SparkSession, source: DataFrame, name: str) -> DataFrame:
    """A stream, taken until its end, into a table below the scratch folder; what the table holds then. The catalog has it, by that name, only while it is written."""
    root = scratch_path(spark, name)
    with _set(spark, LISTING, str(spark.sparkContext.defaultParallelism)):  # a source lists its batches with the session that made it; else each file is a task
        query = source.writeStream.option("checkpointLocation", f"{root}/checkpoint").option("path", f"{root}/table").outputMode("append").trigger(availableNow=True).toTable(name)
        query.awaitTermination()
    spark.sql(f"DROP TABLE {name}")  # its files stay
    return spark.read.schema(source.schema).parquet(f"{root}/table")
