"""Importance resampling against plain Python: CRCs of features whose text is built, gains, scores, ranks."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF
from vigilake.llm import importance, queries
from vigilake.llm.common import numbered, table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
DOCS = "doc_id long, text string"


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=40), st.binary(max_size=40))
def test_joined_crc(a, b):
    got = importance.joined(*(np.array([zlib.crc32(x)], np.uint32) for x in (a, b)), np.array([len(b)]))
    assert got.tolist() == [zlib.crc32(a + b)]


def test_joined_crc_of_long_texts():
    a, tails = b"head", [b"x" * n for n in (0, 1, 255, 256, 65_537, 3_000_001)]
    got = importance.joined(np.full(len(tails), zlib.crc32(a), np.uint32), np.array([zlib.crc32(t) for t in tails], np.uint32), np.array([len(t) for t in tails]))
    assert got.tolist() == [zlib.crc32(a + t) for t in tails]


def features(text, ngrams=2, buckets=10_000):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [zlib.crc32(" ".join(words[i : i + n]).encode()) % buckets for n in range(1, ngrams + 1) for i in range(len(words) - n + 1)]


def expected(docs, target, ngrams=2, buckets=10_000, min_words=20, percent=25, seed=7):
    """(doc_id, features, weight, score, rank) for each row of docs."""
    own = [features(t, ngrams, buckets) for _, t in docs]
    s, t = Counter(x for _, f in own for x in f), Counter(x for text in target for x in features(text, ngrams, buckets)[1])
    total = (sum(s.values()) + buckets, sum(t.values()) + buckets)
    gain = [math.floor(1000 * math.log((t[k] + 1) * total[0] / ((s[k] + 1) * total[1]))) for k in range(buckets)]
    out = []
    for (i, _), (n, f) in zip(docs, own):
        weight = sum(gain[x] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((k for k in range(len(docs)) if own[k][0] >= min_words), key=lambda k: (-out[k][3], docs[k][0] is None, docs[k][0]))
    for rank, k in enumerate(able[: percent * len(able) // 100]):
        out[k][4] = rank + 1
    return sorted(map(tuple, out), key=str)


def run(spark, docs, target, **given):
    out = importance.resample(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(t,) for t in target], "text string"), **given)
    return sorted(map(tuple, out.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    target = [r.text for r in table(spark, SF, "benchmark").collect()]
    assert sorted(map(tuple, queries.op12_importance(spark, SF).collect()), key=str) == expected(docs, target)


def test_features_in_small_pieces(monkeypatch):
    """Texts cut into pieces of 50 bytes, chunks of 30 words, a memory of two words: the buckets of whole texts, text by text."""
    for name, value in (("PIECE", 50), ("REMEMBERED", 2), ("CHUNK_WORDS", 30)):
        monkeypatch.setattr(importance, name, value)
    texts = ["", "A a Ä ä 漢字 x-1", "x" * 500 + " y", "long text 7 " * 40, " ,;", "one two three"]
    got, n_words = [], []
    for owner, found, sizes in importance._features((t.encode() for t in texts), 3, 1000, importance._Words()):
        got += [sorted(found[owner == k].tolist()) for k in range(len(sizes))]
        n_words += sizes.tolist()
    want = [features(t, 3, 1000) for t in texts]
    assert n_words == [n for n, _ in want] and got == [sorted(f) for _, f in want]


@pytest.mark.parametrize("ngrams", [1, 3])
def test_edges(spark, ngrams):
    """Nulls, empty texts, ties and repeats, long texts and words, letters beyond ASCII."""
    docs = [(1, None), (2, ""), (3, " ,;"), (4, "A a Ä ä 漢字 x-1"), (None, "one two"), (5, "again and again"), (5, "again and again"), (6, "x" * 500 + " y"), (7, "long text 7 " * 400), (8, "ß"), (9, "again and again")]
    assert run(spark, docs, ["again and", None], ngrams=ngrams, min_words=1, percent=60) == expected(docs, ["again and", None], ngrams, min_words=1, percent=60)


def test_empty_tables_and_extra_columns(spark):
    docs = [(1, "a b c"), (2, "b")]
    assert run(spark, [], ["a"]) == [] and run(spark, docs, []) == expected(docs, [])
    assert run(spark, docs, ["a"], min_words=1, percent=100) == expected(docs, ["a"], min_words=1, percent=100)
    extra = spark.createDataFrame([(1, "a b", 5, "s")], "doc_id long, text string, weight int, score string")
    assert importance.resample(extra, extra).columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]


def test_numbered(spark):
    rows = numbered(spark.range(1000).selectExpr("id", "id % 10 AS k").repartition(5), "n", F.col("k"), F.col("id"))
    want = sorted((i % 10, i) for i in range(1000))
    assert [(r.k, r.id) for r in sorted(rows.collect(), key=lambda r: r.n)] == want
    assert sorted(r.n for r in rows.collect()) == list(range(1000))
