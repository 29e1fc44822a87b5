import re

import numpy as np
import pytest
import xxhash

from vigilake.llm import graph, simhash


def brute_fingerprint(t):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_fingerprints():
    r = np.random.default_rng(0)
    texts = [None, "", " \n", "one", "One TWO three", "É é É a b c", "a\x0bb\x1cc d e\xa0f g", *[" ".join(r.choice(["aa", "b", "CC", "d\n"], n)) for n in range(1, 60)]]
    assert [simhash.fingerprint(t) for t in texts] == [brute_fingerprint(t) for t in texts]


def classes(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("few", [graph.FEW, 0])
def test_components(spark, few):
    r = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in r.integers(-30, 30, (40, 2))] + [(int(a), int(b)) for a, b in r.permutation([(300 + i, 301 + i) for i in range(500)])] + [(i, i + 1) for i in range(100, 160)] + [(5, 5), (200, 201), (201, 200)]
    df = spark.createDataFrame([*links, (None, 1), (1, None)], "a long, b long")
    got = {x.node: x.root for x in graph.components(df, few=few).collect()}
    want = classes(links, {x for e in links for x in e})
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {k: v for k, v in want.items() if k in linked}
    assert graph.components(df.limit(0), few=few).count() == 0


def test_links_connect_what_is_near(spark):
    """Random values with near ones and crowds within a few bits, from several depths on, with few or many of a bucket compared."""
    r = np.random.default_rng(5)
    base = [int(x) for x in r.integers(0, 1 << 63, 60, np.uint64)]
    flip = lambda x, n: x ^ sum(1 << int(b) for b in r.choice(64, n, replace=False))
    values = {*base, *[flip(x, n) for x in base[:20] for n in (1, 3, 4, 5)], *[flip(base[0], int(r.integers(1, 5))) for _ in range(60)], *[flip(base[1], int(r.integers(3, 9))) for _ in range(120)], 0, (1 << 64) - 1, 1 << 63}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    want = classes([(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 4], values)
    df = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    for few, start in ((1000, None), (1000, 3), (5, None), (1, 2), (1, 6)):
        got = simhash.links(df, few=few, start=start).collect()
        assert all(((x.a ^ x.b) & (1 << 64) - 1).bit_count() <= 4 for x in got)
        mine = classes([(x.a % (1 << 64), x.b % (1 << 64)) for x in got], values)
        assert mine == want, (few, start)
        if few == 1000:
            assert len(got) == len({(x.a, x.b) for x in got})


def test_close_values_share_a_key_at_each_depth():
    r = np.random.default_rng(7)
    for spare in simhash.SPARE:
        keys = simhash._keys(4, 4 + spare)
        for _ in range(50):
            x = int(r.integers(0, 1 << 63, dtype=np.uint64))
            y = x ^ sum(1 << int(b) for b in r.choice(64, 4, replace=False))
            assert any(x & m == y & m for m, _ in keys)


def test_near_duplicates(spark):
    r = np.random.default_rng(8)
    text = [" ".join(r.choice(list("abcdefghijklmnop"), 80)) for _ in range(30)]
    docs = [(i, text[i % 20]) for i in range(40)] + [(50, text[0] + " zz"), (60, None), (61, ""), (62, " "), (3, text[3]), (70, "x y z " * 20000), (None, text[5]), (None, "quite alone here")]
    df = spark.createDataFrame([(*d, 7, "c") for d in docs], "doc_id long, text string, fp long, component_id string")
    got = simhash.near_duplicates(df).collect()
    fps = [(i, brute_fingerprint(t)) for i, t in docs]
    comp = classes([(a, b) for a in {f for _, f in fps} for b in {f for _, f in fps} if a < b and (a ^ b).bit_count() <= 4], {f for _, f in fps})
    least = {}
    for i, f in fps:
        if i is not None:
            least[comp[f]] = min(least.get(comp[f], i), i)
    assert sorted(map(str, ((x.doc_id, x.fp % (1 << 64), x.component_id) for x in got))) == sorted(str((i, f, least.get(comp[f]))) for i, f in fps)
    kept = simhash.keep_representatives(df, simhash.near_duplicates(df))
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([*{v for v in least.values()}, 3, None, None], key=str)
    assert simhash.near_duplicates(df.limit(0)).count() == 0
