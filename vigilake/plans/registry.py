"""A registry of datasets and sinks that depend on one another.

A dataset is a function of its inputs; the registry runs all of them in order, as a batch or as streams that
append to tables. Functions take DataFrames and never read by themselves, so one definition serves both."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


@dataclass(frozen=True)
class Dataset:
    """streams: inputs read as streams; statics: inputs that each micro-batch reads anew, as they are by then.

    build takes streams, then statics. With statics and more than one stream, `over` makes one stream of them first (where
    state lives); build then takes its micro-batches, which it must treat row by row. Of two streams, `pairs` makes rows that
    each come from one row of either, however far apart these arrive: what has arrived is kept in files and not in memory.
    keeps: for pairs, the columns of each stream that are kept; all if none are named."""

    name: str
    build: Callable[..., DataFrame]
    streams: tuple[str, ...]
    statics: tuple[str, ...] = ()
    comment: str = ""
    over: Callable[..., DataFrame] | None = None
    pairs: Callable[[DataFrame, DataFrame], DataFrame] | None = None
    keeps: tuple[tuple[str, ...], tuple[str, ...]] | None = None

    def __post_init__(self):
        if self.pairs and (self.over or len(self.streams) != 2):
            raise ValueError(f"{self.name}: `pairs` needs two streams, and no `over`")
        if self.statics and self.over is None and self.pairs is None and len(self.streams) != 1:
            raise ValueError(f"{self.name}: with statics, several streams need `over` or `pairs`")

    def whole(self, frames: list[DataFrame]) -> DataFrame:
        """Over whole inputs: streams, then statics."""
        streams, statics = frames[: len(self.streams)], frames[len(self.streams) :]
        if self.pairs:
            return self.build(self.pairs(*self.kept(streams)), *statics)
        return self.build(*([self.over(*streams)] if self.over else streams), *statics)

    def kept(self, streams: list[DataFrame]) -> list[DataFrame]:
        """The streams of pairs with the columns that are kept."""
        return [s.select(*names) for s, names in zip(streams, self.keeps)] if self.keeps else streams


@dataclass(frozen=True)
class Sink:
    """A function of each micro-batch and its number, fed by one dataset."""

    name: str
    source: str
    write: Callable[[DataFrame, int], None]


@dataclass
class Registry:
    datasets: dict[str, Dataset] = field(default_factory=dict)
    sinks: dict[str, Sink] = field(default_factory=dict)

    def table(self, name: str, streams: tuple[str, ...], statics: tuple[str, ...] = (), comment: str = "", **given):
        """Registers the decorated function as a dataset; given: over, or pairs and keeps."""

        def register(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
            if name in self.datasets:
                raise ValueError(f"dataset {name} is already registered")
            self.datasets[name] = Dataset(name, build, tuple(streams), tuple(statics), comment, **given)
            return build

        return register

    def sink(self, name: str, source: str):
        """Registers the decorated function as a sink of a dataset."""

        def register(write: Callable[[DataFrame, int], None]):
            self.sinks[name] = Sink(name, source, write)
            return write

        return register

    def order(self) -> list[Dataset]:
        """Datasets, each after those it reads; a cycle is an error."""
        graph = {d.name: [x for x in d.streams + d.statics if x in self.datasets] for d in self.datasets.values()}
        return [self.datasets[n] for n in TopologicalSorter(graph).static_order()]

    def run_batch(self, inputs: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """All datasets over whole inputs, as lazy plans."""
        made = dict(inputs)
        for d in self.order():
            made[d.name] = d.whole([made[x] for x in d.streams + d.statics])
        return made

    def save_batch(self, inputs: dict[str, DataFrame], prefix: str = "") -> dict[str, DataFrame]:
        """run_batch(), with each dataset saved as a table before the next one reads it."""
        made = dict(inputs)
        for d in self.order():
            made[d.name] = save_table(d.whole([made[x] for x in d.streams + d.statics]), f"{prefix}{d.name}")
        return made

    def run_stream(self, spark: SparkSession, tables: dict[str, str], root: str, every: str | None = None, wait: bool = True) -> list[StreamingQuery]:
        """Runs all datasets as a pipeline (see vigilake.plans.pipeline) over parquet tables that are there already.

        wait: takes what is there, dataset by dataset, and ends; a second run goes on where the first one stopped.
        Otherwise the queries keep running, every so often."""
        from vigilake.plans.pipeline import Pipeline, Settings

        inputs = {n: (p, spark.read.parquet(p).schema) for n, p in tables.items()}
        line = Pipeline(spark, self, Settings("flow", root, continuous=not wait, every=every or "30 seconds"), inputs)
        return list(line.run().values())


def create_databases(spark: SparkSession, names: tuple[str, ...] = ("bronze", "silver", "gold", "alert")) -> None:
    for n in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {n}")


def use_catalog(spark: SparkSession, name: str) -> None:
    """Databases are those of this catalog from now on; the session's settings must name its implementation (spark.sql.catalog.{name})."""
    spark.catalog.setCurrentCatalog(name)


def use_database(spark: SparkSession, name: str) -> None:
    """Tables without a database are those of this one from now on."""
    spark.catalog.setCurrentDatabase(name)


def save_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Writes a batch as a table, at a path of its own if one is given, and reads it; a table that exists already is an error."""
    writer = df.write.option("path", path) if path else df.write
    writer.mode("errorifexists").saveAsTable(name)
    return df.sparkSession.table(name)
