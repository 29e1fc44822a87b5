"""Operator 10 against brute force: every alignment of every text with every item."""

import random
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.llm.test_operators import EDGE, frame
from vigilake.llm import decontaminate, queries
from vigilake.llm.common import table


def brute(texts, items):
    """(text, item): (first word, words, equal words), where a window of 13 words (a shorter item) agrees in enough of them."""
    out = {}
    vocab = {}
    code = lambda t: np.array([vocab.setdefault(w, len(vocab) + 1) for w in decontaminate.words_of(t)], np.int64)
    items = [(i, c) for i, t in items if len(c := code(t)) >= 5]
    for d, t in texts:
        ids = code(t)
        for i, c in items:
            m, size = len(c), min(13, len(c))
            need = 11 if size == 13 else size - size // 5
            near = np.concatenate((np.full(m, -1), ids, np.full(m, -1)))
            same = np.lib.stride_tricks.sliding_window_view(near, m) == c
            sums = np.concatenate((np.zeros((len(same), 1), int), same.cumsum(1)), 1)
            inside = np.lib.stride_tricks.sliding_window_view(near >= 0, m)
            whole = np.concatenate((np.zeros((len(same), 1), int), inside.cumsum(1)), 1)
            good = (sums[:, size:] - sums[:, :-size] >= need) & (whole[:, size:] - whole[:, :-size] == size)
            for at in np.flatnonzero(good.any(1)):
                w = np.flatnonzero(good[at])
                a, b = w[0], w[-1] + size
                found = (int(at) - m + int(a), int(b - a), int(sums[at, b] - sums[at, a]))
                if (d, i) not in out or (found[2], -found[0], -found[1]) > (out[d, i][2], -out[d, i][0], -out[d, i][1]):
                    out[d, i] = found
    return out


def rows(df):
    return {(r.doc_id, r.item_id): (r.first_word, r.n_words, r.n_equal) for r in df.collect()}


def test_query_is_as_brute_force(spark):
    """All documents, all items, the registered query; and the same in small blocks of the benchmark."""
    docs, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    assert want and rows(queries.op10_decontaminate(spark, SF)) == want
    assert rows(decontaminate.overlaps(docs, bench, max_words=200)) == want


def test_recall_by_length(spark):
    """Items of each length, some with two texts, with as many words replaced as the rule forgives: none is missed, in any blocks."""
    r = random.Random(4)
    word = lambda n: [f"w{r.randrange(400)}" for _ in range(n)]
    items, texts = [], []
    for n in (5, 6, 8, 9, 10, 11, 12, 13, 14, 20, 40):
        for _ in range(12):
            w = word(n)
            items.append((len(items) // 2, " ".join(w)))
            for at in r.sample(range(n), n // 5 if n < 13 else 2):
                w[at] = "other"
            texts.append((len(texts), " ".join(word(30) + w + word(30))))
    docs, bench = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for turn in range(2):  # both texts of an item count as that item
        for key, v in brute(texts, items[turn::2]).items():
            want[key] = max(v, want.get(key, v), key=lambda x: (x[2], -x[0], -x[1]))
    assert all((k, k // 2) in want for k in range(len(texts)))
    for words in (30, 500_000):
        assert rows(decontaminate.overlaps(docs, bench, max_words=words)) == want


def test_leaks_and_edges(spark):
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(3000)]
    item = [rng.choice(vocab) for _ in range(40)]
    changed = [("other" if k % 9 == 4 else w) for k, w in enumerate(item)]
    clean = [" ".join(rng.choice(vocab) for _ in range(200)) for _ in range(20)]
    leaks = [" ".join(["before"] * 50 + x + ["after"] * 50) for x in (item, changed, item[10:30])]
    docs = frame(spark, leaks + clean + EDGE)
    bench = spark.createDataFrame([(7, " ".join(item)), (7, " ".join(item)), (8, None), (9, "")], "item_id long, text string")
    rows = decontaminate.overlaps(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(0, 7), (1, 7), (2, 7)]
    assert {r.doc_id: (r.first_word, r.n_words, r.n_equal) for r in rows}[0] == (50, 40, 40)
    # The same in many blocks of the benchmark.
    assert sorted(decontaminate.overlaps(docs, bench, max_words=2).collect()) == sorted(rows)
    left = decontaminate.decontaminate(docs, bench)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == set(range(3, docs.count()))
    assert decontaminate.overlaps(docs, bench.limit(0)).count() == 0


def test_short_items_and_scripts_without_spaces():
    """Every pattern of replaced words that the rule forgives is found, for items of 5 words to a bare run of 13."""
    search = lambda items, texts: list(decontaminate._search([lambda: decontaminate.Index([(i, decontaminate.words_of(t)) for i, t in items])], texts))
    for n in range(5, 14):
        item = [f"w{k}" for k in range(n)]
        for some in (c for k in range(n // 5 + 1) for c in combinations(range(n), k)):
            text = " ".join(["before", *("other" if k in some else w for k, w in enumerate(item)), "after"])
            assert [x[1:3] for x in search([(1, " ".join(item))], [text])] != [], (n, some)
    items = [(1, "一个没有空格的问题它的答案是什么呢谁也不知道"), (3, "Antidisestablishmentarianism matters")]
    found = search(items, ["说一个没有空格的问题，它的答案是什么呢？谁也不知道。", "一个完全不同的句子在这里", "so antidisestablishmentarianism, matters", "antidisestablishmentarianism"])
    assert [x[:2] for x in found] == [(0, 1), (2, 3)] and found[0][2:] == (1, 22, 22)


def test_long_items_go_in_pieces(monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE", 30)
    words = [f"w{i}" for i in range(200)]
    parts = decontaminate.pieces(words)
    assert all(any(words[i : i + 13] == p[j : j + 13] for p in parts for j in range(len(p) - 12)) for i in range(188)) and max(map(len, parts)) == 30
    assert decontaminate.pieces(words[:30]) == [words[:30]] and decontaminate.pieces([]) == [[]]


def test_repeats_are_bounded(monkeypatch):
    """A text of one word over and over against an item of the same word: pairs of seeds are made in slices."""
    monkeypatch.setattr(decontaminate, "PAIRS", 1000)
    index = decontaminate.Index([(1, ["a"] * 60)])
    found = list(decontaminate._search([lambda: index], ["a " * 500, "b " * 500 + "a " * 20]))
    assert [(x[0], *x[2:]) for x in found] == [(0, 0, 60, 60), (1, 498, 22, 20)]


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_a_large_benchmark_goes_by_a_shuffle(spark):
    """The whole tables, with a benchmark too large to broadcast: the rows of brute force; copies, null ids, clashing columns, edges."""
    docs, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    assert rows(decontaminate.overlaps(docs, bench, broadcast_words=0)) == want
    leak = next(t for (d, _), _ in want.items() for t in [docs.filter(f"doc_id = {d}").first().text])
    odd = spark.createDataFrame([(None, leak, 5, "x"), (None, leak, 5, "x"), (1, leak, 6, "k"), (2, None, 7, None), (3, "", 8, None), (4, "clean words " * 50, 9, "")], "doc_id long, text string, item_id int, k1 string")
    marked = bench.select((F.when(F.col("item_id") % 2 == 0, F.col("item_id"))).alias("item_id"), "text")
    for b in (bench, marked, bench.limit(0)):
        here, there = (decontaminate.overlaps(odd, b, broadcast_words=n) for n in (0, 10**9))
        assert same(here, there) and here.columns == there.columns
        here, there = (decontaminate.decontaminate(odd, b, broadcast_words=n) for n in (0, 10**9))
        assert same(here, there) and here.columns == there.columns == odd.columns and here.count() == (3 if b.count() else 6)
    assert {r.doc_id for r in decontaminate.overlaps(odd, marked).collect()} == {None, 1}
    assert any(r.item_id is None for r in decontaminate.overlaps(docs, marked).collect())


def test_items_of_few_words(spark):
    """Items of one to four words are found as exact copies where min_words allows; else they are left out, and listed as such."""
    items = [(1, "Lima"), (2, "of Peru"), (3, "capital of Peru"), (4, "the capital of Peru"), (5, "one two three four five"), (6, ""), (7, None), (8, "Antidisestablishmentarianism")]
    texts = [(0, "what is the capital of peru it is lima"), (1, "limap of perus capital"), (2, "one two 3 four five"), (3, "peru of capital the"), (4, "capital: of... PERU!"), (5, None), (6, "antidisestablishmentarianism")]
    docs, bench = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    words = {i: decontaminate.words_of(t) for i, t in (*items, )}

    def expected(least):
        out = set()
        for i, w in words.items():
            for d, t in texts:
                have = decontaminate.words_of(t)
                fits = any(sum(a == b for a, b in zip(w, have[k : k + len(w)])) >= len(w) - len(w) // 5 for k in range(len(have) - len(w) + 1))
                if w and fits and (len(w) >= least or sum(map(len, w)) >= 20):
                    out.add((d, i))
        return out

    for least in (1, 2, 3, 4, 5):
        for broadcast in (0, 10**9):
            got = rows(decontaminate.overlaps(docs, bench, min_words=least, broadcast_words=broadcast))
            assert set(got) == expected(least), (least, broadcast)
        used = {r.item_id: r.used for r in decontaminate.item_sizes(bench, min_words=least).collect()}
        assert used == {i: i == 8 or len(words[i]) >= least and i != 6 for i in used} and 7 not in used
    assert (0, 3) in expected(1) and (2, 5) in expected(5) and decontaminate.decontaminate(docs, bench, min_words=1).count() == 3
