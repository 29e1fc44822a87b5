import re

import numpy as np
import pytest

from tests.conftest import SF
from tests.llm.test_simhash import classes
from vigilake.llm import jaccard
from vigilake.llm.common import table


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return frozenset(" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(texts):
    """The least id of each one's component, by comparing all pairs."""
    sets = {i: shingles(t) for i, t in texts.items()}
    links = [(a, b) for a in sets for b in sets if a < b and (sets[a] == sets[b] or 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]))]
    return classes(links, set(sets)), links


def test_similar_sets_share_a_key():
    r = np.random.default_rng(4)
    tried, far = 0, []
    for _ in range(4000):
        a = np.unique(r.integers(0, 1 << 64, int(r.integers(2, 60) if r.random() < 0.7 else r.integers(60, 900)), np.uint64, endpoint=False))
        gone, new = int(r.integers(0, len(a) // 5 + 1)), int(r.integers(0, len(a) // 4 + 1))
        b = np.unique(np.concatenate((r.permutation(a)[gone:], r.integers(0, 1 << 64, new, np.uint64))))
        both = len(np.intersect1d(a, b))
        if gone + new and 10 * both >= 8 * (len(a) + len(b) - both):
            tried += 1
            assert len(np.intersect1d(jaccard.part_keys(a), jaccard.part_keys(b))) >= max(1, jaccard.must_share(a), jaccard.must_share(b))
            if min(len(a), len(b)) >= jaccard.LARGE:
                far.append(sum((x ^ y).bit_count() if (x ^ y) >= 0 else ((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(jaccard.sketch(a), jaccard.sketch(b))))
    assert tried > 1000 and len(far) > 200 and max(far) <= 40 < jaccard.FAR


@pytest.mark.parametrize("crowd", [64, 3])
def test_stage_is_as_brute_force(spark, monkeypatch, crowd):
    """The stage's own tables, near copies at all distances, a crowd of copies that drift apart, and short texts."""
    import corpus_pipeline
    from vigilake.llm import simhash

    monkeypatch.setattr(jaccard, "CROWD", crowd)
    r = np.random.default_rng(6)
    word = lambda n: [f"w{x}" for x in r.integers(0, 5000, n)]
    made = []
    for n in (6, 9, 14, 30, 80, 300):
        for _ in range(3):
            base = word(n)
            made.append(base)
            for k in (1, 1, 2, 3, 4, 6, 9):
                copy = list(base)
                for at in r.integers(0, n, k):
                    copy[at] = "changed"
                made += [copy, copy[k:], copy + word(k)]
    drift = word(120)
    for _ in range(80):
        drift = list(drift)
        drift[int(r.integers(0, 120))] = word(1)[0]
        made.append(drift)
    texts = {i: t for i, t in enumerate([None, "", " ", "One", "one", "a b", *map(" ".join, made)])}
    docs = table(spark, SF, "documents").select("doc_id", "text")
    texts |= {10_000 + x.doc_id: x.text for x in docs.collect()}
    root, links = brute(texts)
    far = [(a, b) for a, b in links if (simhash.fingerprint(texts[a]) ^ simhash.fingerprint(texts[b])).bit_count() > 4]
    assert len(far) > 50
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    assert {x.doc_id: x.component_id for x in jaccard.near_duplicates(df).collect()} == root
    kept = corpus_pipeline.dedup_stage(spark, df, SF)
    assert sorted(x.doc_id for x in kept.collect()) == sorted({*root.values()})
    assert jaccard.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("size", [2_000_000, 50])
def test_shared_keys_are_never_lost(spark, monkeypatch, size):
    """In few ranges and in many: every key of two different sets passes the filter, and most of the others don't."""
    from collections import defaultdict

    monkeypatch.setattr(jaccard, "RANGE", size)
    docs = table(spark, SF, "documents").select("doc_id", "text").repartition(3)
    sets = jaccard.shingle_sets([r.text for r in docs.collect()])
    owners = defaultdict(set)
    for k, s in enumerate({s.tobytes(): s for s in sets if len(s)}.values()):
        for key in jaccard.part_keys(s).tolist():
            owners[key].add(k)
    got = {r.key & (1 << 64) - 1 for r in jaccard._dealt(docs, jaccard.shared_bits(docs, len(owners)), 5).select("key").distinct().collect()}
    shared = {k for k, o in owners.items() if len(o) > 1}
    assert shared and shared <= got <= set(owners)
    copies = len(sets) - len({s.tobytes() for s in sets})
    assert copies and len(got) < 0.7 * len(owners)
    assert jaccard.shared_bits(docs.limit(0), 0).any() == False  # noqa: E712


@pytest.mark.parametrize("least", [16, 3])
def test_driver_gets_few_bits_of_few_keys(spark, monkeypatch, least):
    """The filter that the driver gets and broadcasts is in proportion to the keys up to its limit, and loses no shared key at any size."""
    monkeypatch.setattr(jaccard, "LEAST_BITS", least)
    texts = [" ".join(f"w{i}-{k}" for k in range(40)) + end for i in range(8) for end in ("", " more")]
    keys = [set(jaccard.part_keys(x).tolist()) for x in jaccard.shingle_sets(texts)]
    shared = set().union(*(a & b for i, a in enumerate(keys) for b in keys[:i]))
    docs, n = spark.createDataFrame([(x,) for x in texts], "text string").repartition(3), len(set().union(*keys))
    bits = jaccard.shared_bits(docs, n)
    assert shared and 8 * bits.nbytes <= max(1 << least, 32 * n)
    assert shared <= {r.key & (1 << 64) - 1 for r in jaccard._dealt(docs, bits, 5).collect()}
    assert jaccard.filter_bits(1 << 40) == jaccard.FILTER_BITS


def test_tables_of_crowds_are_made_for_crowds_only(spark, monkeypatch):
    """Pairs to verify come from a few sets: what only crowded buckets need isn't computed, and the result is brute force's."""
    names, made = [], jaccard.materialize
    monkeypatch.setattr(jaccard, "materialize", lambda df, name: names.append(name) or made(df, name))
    texts = {i: " ".join(f"w{i // 3}-{k}" for k in range(60)) + f" end{i % 3}" for i in range(30)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    assert {x.doc_id: x.component_id for x in jaccard.near_duplicates(df).collect()} == brute(texts)[0]
    assert "similar" in names and not {"stuck", "top", "crowd", "deltas", "news"} & set(names)


def test_parities_differ_in_no_more_bits_than_sets_in_shingles():
    r = np.random.default_rng(5)
    for n in [0, 1, 2, 5, 40, 400, 3000] * 20:
        a = np.unique(r.integers(0, 1 << 64, n, np.uint64))
        b = np.unique(np.concatenate((r.permutation(a)[int(r.integers(0, n + 1)) :], r.integers(0, 1 << 64, int(r.integers(0, n + 1)), np.uint64))))
        bits = sum(int(x).bit_count() for x in (jaccard.parities(a) ^ jaccard.parities(b)).view(np.uint64))
        assert bits <= len(np.setxor1d(a, b))


def test_crowd_that_is_not_similar_makes_few_candidates(spark, monkeypatch):
    """Copies of one text at a similarity of some 0.6 to one another: hardly any pair is verified, the similar ones all are linked."""
    r = np.random.default_rng(7)
    base = [f"b{x}" for x in range(150)]
    texts = {}
    for i in range(400):
        copy = list(base)
        for at in r.choice(150, 7, replace=False):
            copy[at] = f"c{r.integers(0, 1 << 40)}"
        texts[i] = " ".join(copy)
    for i in range(20):
        texts[1000 + i] = texts[i] + " more"
    verified = []
    similar = jaccard._similar
    monkeypatch.setattr(jaccard, "_similar", lambda pairs, own: verified.append(pairs.count()) or similar(pairs, own))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    root, links = brute(texts)
    assert {x.doc_id: x.component_id for x in jaccard.near_duplicates(df).collect()} == root
    assert 20 <= len(links) and sum(verified) < 4 * len(texts)


def test_simhash_blocks_link_what_is_close_before_sets_are_dealt(spark, monkeypatch):
    """No key of the sets passes the filter, so all links come by blocks of fingerprints: those of similar sets at up to four bits."""
    r = np.random.default_rng(8)
    word = lambda n: [f"w{x}" for x in r.integers(0, 9000, n)]
    texts = {}
    for n in (40, 200, 600):
        for _ in range(6):
            base = word(n)
            for k in (0, 1, 1, 2, 3):
                copy = list(base)
                for at in r.integers(0, n, k):
                    copy[at] = "changed"
                texts[len(texts)] = " ".join(copy)
    value = {i: jaccard.sketch(x)[0] for i, x in enumerate(jaccard.shingle_sets([*texts.values()]))}
    links = brute(texts)[1]
    close = [(a, b) for a, b in links if ((value[a] ^ value[b]) & (1 << 64) - 1).bit_count() <= 4]
    assert 30 < len(close) < len(links)
    monkeypatch.setattr(jaccard, "shared_bits", lambda *given: np.zeros(1 << (jaccard.FILTER_BITS - 3), np.uint8))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    assert {x.doc_id: x.component_id for x in jaccard.near_duplicates(df).collect()} == classes(close, set(texts))
