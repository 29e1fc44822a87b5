"""The pipeline's stages on an empty table, and on rows with clashing columns, nulls, repeats and ties."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from vigilake.llm import queries
from vigilake.llm.common import materialize, table

CLASH = ["shard", "size", "slot", "part", "epoch", "block", "key", "nth", "fp", "component_id", "n_words", "kept", "item_id", "n_tokens", "quality", "toxic"]
OUT = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def through(spark, docs, first=0):
    """What each stage gives, one after the other."""
    import corpus_pipeline

    for name, stage in corpus_pipeline.STAGES[first:]:
        docs = materialize(stage(spark, docs, SF), name)
        yield name, docs


def clashing(docs):
    return docs.withColumns({c: F.concat(F.lit(f"{c} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in CLASH})


@pytest.mark.parametrize("wrap", [lambda d: d, clashing], ids=["plain", "clashing"])
def test_empty(spark, wrap):
    docs = wrap(table(spark, SF, "documents").limit(0))
    for name, out in through(spark, docs):
        assert out.count() == 0 and out.columns == (OUT if name == "shard" else docs.columns)


def test_clashing_columns_change_nothing(spark):
    """All stages keep each row's own values and the documents that they keep without such columns."""
    plain, docs = table(spark, SF, "documents"), clashing(table(spark, SF, "documents"))
    for (name, a), (_, b) in zip(through(spark, plain), through(spark, docs)):
        assert {r.doc_id for r in a.select("doc_id").collect()} == {r.doc_id for r in b.select("doc_id").collect()}
        if name != "shard":
            assert b.columns == docs.columns
            assert b.filter(" OR ".join(f"NOT `{c}` <=> concat('{c} ', doc_id)" for c in CLASH)).isEmpty()
        else:
            assert b.columns == OUT
    assert {r.doc_id for r in queries.op7_quality_rules(spark, SF).filter("kept").select("doc_id").collect()} >= {r.doc_id for r in b.select("doc_id").collect()}


def test_nulls_and_repeats(spark):
    """Behind the quality rules, which reject such texts: one of all blank texts stays; rows of one id, and those without id, stay all."""
    rows = [(1, None, "en", "a", 0), (2, "", None, None, 0), (3, " \n", "en", "a", 3), (4, "a few words that stand twice here", "en", "a", 33), (4, "a few words that stand twice here", "en", "a", 33)]
    rows += [(None, "this one has no id but a text of its own", None, None, None), (None, "this one has no id but a text of its own", "en", "b", 40), (7, "long " * 50_000, "en", "b", 250_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    last = None
    for name, out in through(spark, docs, first=1):
        found = Counter(r.doc_id for r in out.select("doc_id").collect())
        if name in ("near_dedup", "decontaminate"):
            assert found == {1: 1, 4: 2, None: 2, 7: 1}
        assert set(found) == {1, 4, None, 7}
        last = out.collect()
    assert all(sorted(r.slot for r in last if r.shard == s) == list(range(n)) for s, n in Counter(r.shard for r in last).items())
