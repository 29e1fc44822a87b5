"""Operator 9, with the settings of its registered query."""

import random

import numpy as np
import pytest

from tests.conftest import SF
from tests.llm.test_operators import EDGE, frame
from vigilake.llm import lm_score, queries
from vigilake.llm.common import materialize, table
from vigilake.llm.word_hash import hash_words


def fitted(docs, **settings):
    vocab = lm_score.vocabulary(materialize(lm_score.count_words(docs), "words"))
    return vocab, lm_score.fit(lm_score.encode(docs, vocab), vocab.counts, **settings)


def plain_score(text, vocab, net, shares):
    """Word by word, with both softmaxes over all of their values."""
    p = {k: v.astype(float) for k, v in net.p.items()}
    words = [hash_words([w])[0] for w in lm_score.words_of(text)]
    ids = [lm_score.PAD] * 2 + [int(vocab.ids(w)[0]) for w in words] + [lm_score.PAD] * 2
    total = 0.0
    for k, w in enumerate(words):
        h = np.tanh(np.concatenate([p["e"][ids[k + j]] for j in (0, 1, 3, 4)]) @ p["w"] + p["b"])
        kind, member = divmod(ids[k + 2], lm_score.MEMBERS)
        for z, at in ((p["c"][:, :-1] @ h + p["c"][:, -1], kind), (p["m"][kind][:, :-1] @ h + p["m"][kind][:, -1], member)):
            total += z[at] - np.log(np.exp(z).sum())
        if ids[k + 2] >= lm_score.KNOWN:
            total += shares.get(int(w.view(np.int64)[0]), vocab.unseen[ids[k + 2] - lm_score.KNOWN])
    return total


def test_query_is_as_plain_python(spark):
    """All documents, the registered query; and the same scores whatever the partitions."""
    docs = table(spark, SF, "documents")
    vocab, net = fitted(docs)
    shares = {r.word: r.share for r in vocab.shares.collect()}
    want = {r.doc_id: plain_score(r.text, vocab, net, shares) for r in docs.collect()}
    got = {r.doc_id: r.log_prob for r in queries.op9_lm_score(spark, SF).collect()}
    assert got == pytest.approx(want, rel=1e-4, abs=1e-2)
    for n in (1, 8):
        rows = lm_score.train_and_score(docs.repartition(n)).collect()
        assert {r.doc_id: r.log_prob for r in rows} == pytest.approx(got, rel=1e-4, abs=1e-2)


def test_layout_and_copies_decide_nothing(spark):
    """Several parts and rounds, a text with more copies than parts, another with fewer."""
    rng = random.Random(5)
    texts = [" ".join(rng.choice(("ab", "cd", "ef", f"w{i}")) for _ in range(200)) for i in range(60)] + ["a text that stands here often"] * 100 + ["and another one"] * 3
    docs, got = frame(spark, texts), []
    for layout in (docs.repartition(1), docs.repartition(7), docs.orderBy("text")):
        rows = lm_score.train_and_score(layout, part_words=1000).collect()
        got.append({r.doc_id: r.log_prob for r in rows})
    assert len(got[0]) == len(texts) and got[1] == pytest.approx(got[0], rel=1e-4) and got[2] == pytest.approx(got[0], rel=1e-4)


def test_learns_order(spark):
    rng = random.Random(2)
    order = lambda: " ".join(w for _ in range(60) for w in rng.choice((["the", "cat", "sat"], ["a", "dog", "ran"])))
    vocab, net = fitted(frame(spark, [order() for _ in range(1200)]))
    held = [order() for _ in range(10)]
    mixed = [" ".join(rng.sample(t.split(), len(t.split()))) for t in held]
    rows = {r.doc_id: r for r in lm_score.score(frame(spark, held + mixed), vocab, net).collect()}
    assert min(rows[i].mean_log_prob for i in range(10)) > max(rows[i].mean_log_prob for i in range(10, 20))
    ctx, target = np.zeros((lm_score.PAD, 2 * lm_score.SIDE), np.uint16), np.arange(lm_score.PAD)
    assert np.exp(net.log_probs(ctx, target)).sum() == pytest.approx(1, abs=1e-3)


def test_gradients():
    """Each step's gradients against differences of the loss."""
    r = np.random.default_rng(1)
    net = lm_score.Network.start(np.ones(lm_score.PAD))
    net.p = {k: (v + r.normal(0, 0.3, v.shape)).astype(np.float32) for k, v in net.p.items()}
    ctx, target, weight = r.integers(0, 50, (40, 4)).astype(np.uint16), r.integers(0, 300, 40).astype(np.uint16), r.integers(1, 4, 40).astype(float)
    loss = lambda: -(net.log_probs(ctx, target).astype(float) * weight).sum() / weight.sum()
    before, square = {k: v.copy() for k, v in net.p.items()}, {k: np.zeros_like(v) for k, v in net.p.items()}
    net.train(ctx, target, weight, square)
    after = net.p
    for name, s in square.items():
        net.p = {k: v.copy() for k, v in before.items()}
        at = np.unravel_index(np.argmax(s), s.shape)
        net.p[name][at] += 0.01
        up = loss()
        net.p[name][at] -= 0.02
        slope = (up - loss()) / 0.02
        assert abs(slope) == pytest.approx(np.sqrt(s[at]), rel=0.05) and (after[name][at] < before[name][at]) == (slope > 0)


def test_edges(spark):
    """Nulls, empty and long texts, repeated rows, null ids, clashing columns, an empty table; one word is a target as well."""
    edge = frame(spark, EDGE).unionByName(frame(spark, EDGE).filter("doc_id > 8")).selectExpr("CASE WHEN doc_id <> 3 THEN doc_id END AS doc_id", "text", "source AS words", "shard AS ids", "n_tokens AS n", "size AS row", "count AS part")
    out = lm_score.train_and_score(edge).collect()
    assert len(out) == edge.count() and all((r.mean_log_prob is None) == (r.n_words == 0) for r in out)
    assert lm_score.train_and_score(edge.limit(0)).count() == 0
    vocab, net = fitted(frame(spark, ["lone"]))
    assert (net.p["c"] != lm_score.Network.start(vocab.counts).p["c"]).any()


def test_unseen_words_score_below_known_ones(spark):
    rng = random.Random(3)
    often = [f"k{i}" for i in range(lm_score.KNOWN)]
    seldom = [f"r{i}" for i in range(4000)]
    texts = [" ".join(rng.sample(often, len(often))) for _ in range(4)] + [" ".join(seldom[i : i + 100]) for i in range(0, 4000, 100)] + [" ".join(seldom[:100])]
    vocab, _ = lm_score.train(frame(spark, texts))
    start = lm_score.Network.start(vocab.counts)
    held = [" ".join(often[:100]), " ".join(seldom[:100]), " ".join(seldom[100:200]), " ".join(f"never{i}" for i in range(100))]
    rows = {r.doc_id: r for r in lm_score.score(frame(spark, held + ["r7", "r7 r7"]), vocab, start).collect()}
    known, twice, once, never = (rows[i].mean_log_prob for i in range(4))
    assert known > twice > once > never
    total = 4 * len(often) + 4100
    assert abs(rows[4].log_prob - np.log(2 / total)) < 0.3 and rows[5].log_prob == pytest.approx(2 * rows[4].log_prob, abs=1e-3)
