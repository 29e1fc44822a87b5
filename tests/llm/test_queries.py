"""Registered queries against their SQL, or against plain Python over the same whole tables."""

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tests.conftest import SF
from tests.oracle import differences
from vigilake.llm import queries
from vigilake.llm.common import table


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_as_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF), SF, queries.ORACLE_SQL[name]) == ""


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in table(spark, SF, "documents").collect()}


def test_op2(spark, docs):
    from vigilake.llm.simhash import fingerprint

    rows = {r.doc_id: r for r in queries.op2_simhash(spark, SF).collect()}
    fps = {i: fingerprint(r.text) for i, r in docs.items()}
    assert {i: r.fingerprint for i, r in rows.items()} == {i: f"{x:016x}" for i, x in fps.items()}
    root = {i: i for i in fps}
    ids = sorted(fps)
    while True:
        before = dict(root)
        for i in ids:
            root[i] = min(root[j] for j in ids if (fps[i] ^ fps[j]).bit_count() <= 4)
        if root == before:
            break
    assert {i: r.component_id for i, r in rows.items()} == root


def test_op4(spark, docs):
    from tokenizers import Tokenizer

    tokenizer, start, want = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json"))), 0, {}
    for i in sorted(docs):
        ids = tokenizer.encode(docs[i].text or "", add_special_tokens=False).ids + [1]
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op4_token_files(spark, SF).collect()} == want


def test_op5(spark, docs):
    rows = queries.op5_sharding(spark, SF).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {i: (len((d.text or "").encode()) + 16, zlib.crc32((d.text or "").encode())) for i, d in docs.items()}
    assert len(rows) == len(docs)
    counts = Counter(r.shard for r in rows)
    assert set(counts) == set(range(40)) and max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(n)) for s, n in counts.items())
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}


def test_op6(spark, docs):
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))
    want = {i: (len((d.text or "").encode()), n := len(sp.encode(d.text or "")), n > 4096) for i, d in docs.items()}
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.op6_token_counts(spark, SF).collect()} == want


def test_op7_base(spark, docs):
    rows = {r.doc_id: r for r in queries.op7_quality_rules(spark, SF).collect()}
    assert set(rows) == set(docs)
    for i, d in docs.items():
        text = d.text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        grams = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        often, again = Counter(grams), set()
        for k, g in enumerate(grams):
            if often[g] > 1:
                again.update(range(k, k + 8))
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again)), i
        assert r.base_failed == (len(w) < 20 or 100 * len(again) > 30 * len(w))
        assert r.kept == (not r.base_failed and not r.failed_rules)


def test_op8(spark, docs):
    """Weights, budgets and epochs as plain Python has them, whole permutations, and blocks that hold each source's share."""
    rows = queries.op8_mix(spark, SF).collect()
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")) for i, d in docs.items()}
    assert all(r.n_tokens == words[r.doc_id] and r.source == docs[r.doc_id].source for r in rows)
    tokens = Counter()
    for i, d in docs.items():
        tokens[d.source] += words[i]
    top, low = max(tokens.values()), min(tokens.values())
    exponent = min(1, max(0, 1 - np.log(4) / np.log(top / low))) if top > low else 1
    copies = Counter((r.doc_id, r.epoch) for r in rows)
    assert max(copies.values()) == 1 and max(r.epoch for r in rows) <= 3
    for source, n in tokens.items():
        epochs = (n / top) ** (exponent - 1)
        own = [i for i, d in docs.items() if d.source == source]
        done = sum(r.n_tokens for r in rows if r.source == source)
        assert -1e-6 * n <= done - epochs * n <= max(words[i] for i in own)
        for epoch in range(int(epochs + 1e-6)):
            assert all((i, epoch) in copies for i in own)
    slots, share = {}, {}
    for r in rows:
        slots.setdefault(r.block, []).append(r.slot)
        share.setdefault(r.block, Counter())[r.source] += r.n_tokens
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    total = sum(r.n_tokens for r in rows)
    for block in share.values():
        for source in tokens:
            want = sum(r.n_tokens for r in rows if r.source == source) / total
            assert abs(block[source] / sum(block.values()) - want) < 0.1


def test_pipeline(spark, docs):
    """Each stage by plain Python on what the one before it keeps, but for the learned cutoffs."""
    import corpus_pipeline
    from tests.llm.test_decontaminate import brute as leaks
    from tests.llm.test_jaccard import brute as classes

    rows = corpus_pipeline.run(spark, SF).collect()
    kept = {r.doc_id for r in queries.op7_quality_rules(spark, SF).filter("kept").collect()}
    root, _ = classes({i: docs[i].text for i in sorted(kept)})
    first = {i for i, r in root.items() if i == r}
    found = leaks([(i, docs[i].text) for i in first], [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()])
    left = first - {i for i, _ in found}
    assert {r.doc_id for r in rows} == left and len(left) < len(first) < len(kept) < len(docs)
    assert all((r.size, r.text_crc32) == (len((docs[r.doc_id].text or "").encode()) + 16, zlib.crc32((docs[r.doc_id].text or "").encode())) for r in rows)
    times, tokens = Counter(r.doc_id for r in rows), Counter()
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", docs[i].text or "")) for i in left}
    for i in left:
        tokens[docs[i].source] += words[i]
    top, low = max(tokens.values()), min(tokens.values())
    exponent = min(1, max(0, 1 - np.log(4) / np.log(top / low))) if top > low else 1
    for source, n in tokens.items():
        own = [i for i in left if docs[i].source == source]
        epochs, done = (n / top) ** (exponent - 1), sum(times[i] * words[i] for i in own)
        assert -1e-6 * n <= done - epochs * n <= max(words[i] for i in own) and max(times[i] for i in own) - min(times[i] for i in own) <= 1
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1 or len(rows) < 40
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(n)) for s, n in counts.items())
