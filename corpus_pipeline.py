"""A corpus pipeline: quality rules, near-dedup, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept; all but the last give
the columns of documents. What a stage gives must be written before the next one is called, which then removes the
scratch tables of the one before. ORACLE_SQL is None: SQL can express neither the fingerprints' links nor the seeded
permutations; tests/llm holds the pipeline against plain Python."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from vigilake.llm import decontaminate, jaccard, mixing, quality, sharding, simhash
from vigilake.llm.common import drop_path, made_since, materialize, table

ORACLE_SQL: str | None = None


#: Scratch tables that the last call of each stage made, by the stage's name.
_left: dict[str, list[tuple[SparkSession, str]]] = {}


def _after(before: str | None, name: str):
    """A stage that removes what the stage before it left."""

    def wrap(stage):
        @wraps(stage)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            for own, path in _left.pop(before, []):
                drop_path(own, path)
            made = len(made_since(0))
            out = stage(spark, docs, sf_dir)
            _left[name] = made_since(made)
            return out

        return run_stage

    return wrap


@_after(None, "quality")
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.quality_filter(docs, table(spark, sf_dir, "labels"))


@_after("quality", "near_dedup")
def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8): the one of least doc_id."""
    return simhash.keep_representatives(docs, jaccard.near_duplicates(docs))


@_after("near_dedup", "decontaminate")
def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


@_after("decontaminate", "mix")
def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once at least, and those of small sources up to four times, by temperature mixing."""
    counted = mixing.countable(docs)
    mix = mixing.solve_mix(counted, max_repeats=4.0)
    return mixing.apply_mix(docs, mix, mixing.realise(counted, mix))


@_after("mix", "shard")
def shard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """40 shards of shuffled rows are written; where each row stands in them."""
    return sharding.shard_and_read(docs)


STAGES = [("quality", quality_stage), ("near_dedup", dedup_stage), ("decontaminate", decontaminate_stage), ("mix", mix_stage), ("shard", shard_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
