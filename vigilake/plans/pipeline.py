"""A registry of datasets that runs: all of them as streams, under one supervisor, from a pipeline file.

Schemas come from the plans, so a pipeline starts before there are any data. A dataset without static inputs appends to its
table through Spark's file sink. One with static inputs reads those anew in each micro-batch, as they are by then, and each
micro-batch is a folder of its table, named by its number, which appears at once: one that is run again is not written twice.
One with pairs keeps what its two streams brought as files, by micro-batch: what comes on one side meets all that has come on
the other, in joins that may spill, so that an executor's memory doesn't grow with what is kept.
Tables are read with Pipeline.table(), or by their names in the target database."""

from __future__ import annotations

import contextlib
import json
import logging
import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from vigilake import storage
from vigilake.plans.registry import Dataset, Registry
from vigilake.sources.snapshots import Snapshots
from vigilake.streaming import replay

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Settings:
    """What a pipeline file says.

    storage: folder of tables and checkpoints. target: database in which tables get their names. continuous: keeps running
    and takes new data every so often; else takes what is there and ends. A query that fails is started again after
    back_off seconds, then twice as many and so on; after max_restarts failures without a batch between them all stops."""

    name: str
    storage: str
    target: str | None = None
    continuous: bool = False
    every: str = "30 seconds"
    max_restarts: int = 5
    back_off: float = 1.0

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Settings:
        """Of a JSON file with these fields; unknown ones are an error."""
        given = json.loads(storage.text(spark, path))
        if unknown := set(given) - {f.name for f in fields(cls)}:
            raise ValueError(f"{path}: unknown {', '.join(sorted(unknown))}")
        return cls(**given)


Input = tuple[str, T.StructType] | Snapshots

#: Columns, and folders, of what pairs keep: a row stands in the column of its side.
SIDES, SIDE, BATCH = ("left", "right"), "__side", "__batch"


def _either(left: DataFrame, right: DataFrame) -> DataFrame:
    """One stream of both."""
    ours, theirs = F.struct(*left.columns), F.struct(*right.columns)
    return left.select(ours.alias("left"), F.lit(None).cast(right.schema).alias("right"), F.lit("left").alias(SIDE)).union(right.select(F.lit(None).cast(left.schema).alias("left"), theirs.alias("right"), F.lit("right").alias(SIDE)))


class Pipeline:
    """inputs: parquet folders with their schemas, which may still be empty, or (static ones only) Snapshots."""

    def __init__(self, spark: SparkSession, registry: Registry, settings: Settings, inputs: dict[str, Input]):
        self.spark, self.registry, self.settings, self.inputs = spark, registry, settings, inputs
        self.queries: dict[str, StreamingQuery] = {}
        self.restarts: dict[str, int] = {}
        self.failure: BaseException | None = None
        self.schemas: dict[str, T.StructType] = {n: x.schema if isinstance(x, Snapshots) else x[1] for n, x in inputs.items()}
        self._starts: dict[str, Callable[[bool], StreamingQuery]] = {}
        self._stopping, self._watcher = threading.Event(), None
        self.parts = spark.conf.get(replay.PARTS)  # for joins with statics, which keep no state
        for n, x in inputs.items():
            if not isinstance(x, Snapshots):
                storage.make_folder(spark, x[0])
        self._resolve()

    # -- tables

    def _path(self, name: str) -> str:
        return self.inputs[name][0] if name in self.inputs else f"{self.settings.storage}/tables/{name}"

    def table(self, name: str, spark: SparkSession | None = None) -> DataFrame:
        """What a dataset or an input holds now."""
        spark = spark or self.spark
        if isinstance(found := self.inputs.get(name), Snapshots):
            return found.read(spark)
        return spark.read.schema(self.schemas[name]).option("recursiveFileLookup", True).parquet(self._path(name))

    def _stream(self, name: str) -> DataFrame:
        if isinstance(self.inputs.get(name), Snapshots):
            raise ValueError(f"{name} comes in versions and can't be a stream")
        return self.spark.readStream.schema(self.schemas[name]).option("recursiveFileLookup", True).parquet(self._path(name))

    # -- plans

    def _resolve(self) -> None:
        """Every dataset's plan and schema, from those of what it reads."""
        for d in self.registry.order():
            frames = [self._stream(x) for x in d.streams]
            if d.pairs:
                stream = _either(*d.kept(frames))
                empty = [self.spark.createDataFrame([], self.schemas[x]) for x in d.streams + d.statics]
                self.schemas[d.name] = d.whole(empty).schema
                if storage.exists(self.spark, f"{self._checkpoint(d.name)}/state"):
                    raise ValueError(f"{d.name}: its checkpoint has rows of the streams as state; pairs begin with a new one")
                self._starts[d.name] = self._starter(d.name, stream, self._paired(d, stream.schema))
            elif d.statics:
                stream = d.over(*frames) if d.over else frames[0]
                self.schemas[d.name] = d.build(self.spark.createDataFrame([], stream.schema), *[self.spark.createDataFrame([], self.schemas[x]) for x in d.statics]).schema
                self._starts[d.name] = self._starter(d.name, stream, self._batches(d))
            else:
                stream = d.build(*frames)
                self.schemas[d.name] = stream.schema
                self._starts[d.name] = self._starter(d.name, stream, None)
            storage.make_folder(self.spark, self._path(d.name))
            if self.settings.target and not self.spark.catalog.tableExists(f"{self.settings.target}.{d.name}"):
                self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.settings.target}")
                self.spark.catalog.createTable(f"{self.settings.target}.{d.name}", self._path(d.name), "parquet", self.schemas[d.name], d.comment or None, recursiveFileLookup="true")
        for s in self.registry.sinks.values():
            self._starts[s.name] = self._starter(s.name, self._stream(s.source), s.write)

    def _batches(self, d: Dataset) -> Callable[[DataFrame, int], None]:
        def write(batch: DataFrame, batch_id: int) -> None:
            spark, done = batch.sparkSession, f"{self._path(d.name)}/batch-{batch_id:09d}"
            if storage.exists(spark, done):  # it was written, and the query ended before it could say so
                batch.write.format("noop").mode("overwrite").save()  # a stream's state must go on all the same
                return
            staged = f"{self.settings.storage}/staged/{d.name}/batch-{batch_id:09d}"
            with contextlib.nullcontext() if d.over else replay.as_batch(spark, self.parts):
                d.build(batch, *[self.table(x, spark) for x in d.statics]).write.mode("overwrite").parquet(staged)
            storage.move(spark, staged, done)

        return write

    def _paired(self, d: Dataset, schema: T.StructType) -> Callable[[DataFrame, int], None]:
        root = f"{self.settings.storage}/kept/{d.name}"
        for side in SIDES:
            storage.make_folder(self.spark, f"{root}/{side}")

        def kept(side: str, which: str) -> DataFrame:
            """Of the session that made the pipeline, not of the stream: the joins are adaptive and have its number of parts."""
            rows = self.spark.read.schema(T.StructType([f for f in schema if f.name in SIDES]).add(BATCH, "long")).parquet(f"{root}/{side}")
            return rows.filter(f"{BATCH} {which}").select(f"{side}.*")

        def write(batch: DataFrame, batch_id: int) -> None:
            spark, done = batch.sparkSession, f"{self._path(d.name)}/batch-{batch_id:09d}"
            if storage.exists(spark, done):
                return
            arrived, staged = (f"{self.settings.storage}/{x}/{d.name}/batch-{batch_id:09d}" for x in ("arrived", "staged"))
            with replay.writers(spark, len(SIDES)):
                batch.write.mode("overwrite").partitionBy(SIDE).parquet(arrived)
            for side in SIDES:
                target = f"{root}/{side}/{BATCH}={batch_id}"
                if storage.exists(spark, f"{arrived}/{SIDE}={side}") and not storage.exists(spark, target):  # it may have been moved before a failure
                    storage.move(spark, f"{arrived}/{SIDE}={side}", target)
            storage.delete(spark, arrived)
            found = d.pairs(kept("left", f"= {batch_id}"), kept("right", f"<= {batch_id}"))
            if storage.exists(spark, f"{root}/right/{BATCH}={batch_id}"):
                found = found.union(d.pairs(kept("left", f"< {batch_id}"), kept("right", f"= {batch_id}")))
            d.build(found, *[self.table(x) for x in d.statics]).write.mode("overwrite").parquet(staged)
            storage.move(spark, staged, done)

        return write

    def _checkpoint(self, name: str) -> str:
        return f"{self.settings.storage}/checkpoints/{name}"

    def _starter(self, name: str, frame: DataFrame, write: Callable[[DataFrame, int], None] | None) -> Callable[[bool], StreamingQuery]:
        def start(once: bool) -> StreamingQuery:
            writer = frame.writeStream.queryName(f"{self.settings.name}-{name}").option("checkpointLocation", self._checkpoint(name)).outputMode("append")
            writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=self.settings.every)
            writer = writer.foreachBatch(write) if write else writer.format("parquet").option("path", self._path(name))
            return writer.start()

        return start

    # -- running

    def run(self) -> dict[str, StreamingQuery]:
        """Starts all queries and the supervisor; or, if not continuous, runs each one, after those it reads, to the end of what is there."""
        self._stopping.clear()
        for name, start in self._starts.items():
            with replay.few_parts(self.spark):
                self.queries[name] = start(not self.settings.continuous)
            if not self.settings.continuous:
                self.queries[name].awaitTermination()
                self._refresh(name)
        if self.settings.continuous:
            self._watcher = threading.Thread(target=self._watch, name=f"{self.settings.name}-supervisor", daemon=True)
            self._watcher.start()
        return self.queries

    def _watch(self) -> None:
        due: dict[str, float] = {}
        seen = dict.fromkeys(self._starts, -1)
        while not self._stopping.wait(0.1):
            for name, query in list(self.queries.items()):
                # Only what brought rows was a batch; idle queries report the number of the one to come.
                if (progress := query.lastProgress) and progress["numInputRows"] and progress["batchId"] > seen[name]:
                    seen[name], self.restarts[name] = progress["batchId"], 0
                    self._refresh(name)
                if query.isActive:
                    continue
                if name not in due:
                    failed = self.restarts[name] = self.restarts.get(name, 0) + 1
                    if failed > self.settings.max_restarts:
                        log.error("%s failed %s times; all stops", name, failed)
                        self._end()  # before wait() and drain() can tell
                        self.failure = query.exception() or RuntimeError(f"{name} ended")
                        self._stopping.set()
                        return
                    due[name] = time.monotonic() + self.settings.back_off * 2 ** (failed - 1)
                    log.warning("%s failed and starts again: %s", name, query.exception())
                elif time.monotonic() >= due[name]:
                    del due[name]
                    try:
                        self.queries[name] = self._starts[name](False)
                    except PySparkException:
                        log.exception("%s can't start", name)  # counts as one more failure

    def _refresh(self, name: str) -> None:
        """The session's list of the files of a dataset's named table is out of date after a batch."""
        if self.settings.target and name in self.registry.datasets:
            self.spark.catalog.refreshTable(f"{self.settings.target}.{name}")

    def drain(self, timeout: float = 600) -> None:
        """Waits until all that is there now has gone through every dataset and sink."""
        until = time.monotonic() + timeout
        for name in self._starts:
            while True:
                if self.failure:
                    raise self.failure
                try:
                    self.queries[name].processAllAvailable()
                    if self.queries[name].isActive:
                        break
                except PySparkException:
                    pass  # the supervisor starts it again
                if time.monotonic() > until:
                    raise TimeoutError(f"{name} did not take all within {timeout} seconds")
                time.sleep(0.1)
            self._refresh(name)

    def _end(self) -> None:
        for query in self.queries.values():
            query.stop()

    def stop(self, drain: bool = False) -> None:
        """Stops the queries, each after those it reads; drain: not before all that is there has gone through."""
        if drain:
            self.drain()
        self._stopping.set()
        if self._watcher and self._watcher is not threading.current_thread():
            self._watcher.join()
        self._end()

    def wait(self) -> None:
        """Until the pipeline is stopped; raises what made it fail."""
        self._stopping.wait()
        if self.failure:
            raise self.failure
