import math
import re
from collections import Counter

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigilake.llm import quality


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    count, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            covered.update(range(i, i + 8))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines), len(lines) - len(set(lines)), len(covered)


NAMES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
TEXT = st.one_of(st.none(), st.text("ab \n\t#é|", max_size=60), st.lists(st.sampled_from(["a", "b", "c", "\n"]), max_size=60).map(" ".join), st.integers(8, 30).map(lambda n: "x " * n))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(st.lists(TEXT, max_size=40))
def test_metrics(spark, texts):
    df = spark.createDataFrame([(i, t, 1, "w") for i, t in enumerate(texts)], "doc_id long, text string, n int, w string")
    got = {r.doc_id: tuple(r[n] for n in NAMES) for r in quality.text_metrics(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_long_texts(spark):
    long = "the same eight words stand here again and " * 3000
    got = quality.text_metrics(spark.createDataFrame([(1, long), (2, "x" * 300_000)], "doc_id long, text string")).collect()
    assert sorted(tuple(r[n] for n in NAMES) for r in got) == sorted(map(brute, (long, "x" * 300_000)))


def tail(k, n, p):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def test_binomial_tail(spark):
    cases = [(k, n, p) for n in (1, 7, 150, 900) for p in (0.005, 0.0125, 0.2) for k in range(0, min(n, 40), 3)]
    for p in {c[2] for c in cases}:
        own = [(k, n) for k, n, q in cases if q == p]
        got = {(r.k, r.n): r.v for r in spark.createDataFrame(own, "k long, n long").select("k", "n", quality.binomial_tail(F.col("k"), F.col("n"), p).alias("v")).collect()}
        for k, n in own:
            assert got[k, n] == 1 if k >= n * p else abs(got[k, n] / tail(k, n, p) - 1) < 1e-9, (k, n, p)


def corpus(n, bad_every=10, seed=1):
    r = np.random.default_rng(seed)
    docs, labels = [], []
    for i in range(n):
        words = ["".join(r.choice(list("abcdefgh"), 5)) for _ in range(60)]
        if i % bad_every == 0:
            words[::2] = ["##**"] * 30
        docs.append((i, " ".join(words), "en" if i % 3 else None, "s", 1))
        labels.append((i, int(i % bad_every != 0)))
    return docs, labels


DOCS = "doc_id long, text string, lang string, stratum string, n long"


def test_rules_keep_the_good(spark):
    docs, labels = corpus(2000)
    out = quality.quality_rules(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert {r.doc_id for r in out if not r.kept} == {i for i in range(0, 2000, 10)}
    kept = quality.quality_filter(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int"))
    assert kept.columns == ["doc_id", "text", "lang", "stratum", "n"] and kept.count() == 1800


def test_risk_is_held(spark):
    """Good and bad overlap: among good documents of a second draw, no stratum loses more than the risk."""
    r = np.random.default_rng(7)

    def draw(n):
        good = r.random(n) < 0.8
        return [(i, "en", 100, 500, int(500 * max(0, r.normal(0.03 if g else 0.2, 0.02))), 10, 0, 0, bool(g)) for i, g in enumerate(good)]

    schema = "doc_id long, stratum string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, good boolean"
    cuts = quality.risk_cutoffs(spark.createDataFrame(draw(8000), schema)).collect()
    (symbols,) = [c for c in cuts if c.rule == "symbols"]
    again = [x for x in draw(8000) if x[-1]]
    lost = sum(x[4] / x[3] > symbols.cutoff for x in again) / len(again)
    assert lost <= 0.05 / len(quality.RULES)


def test_labels_that_say_little(spark):
    docs, _ = corpus(40)
    df = spark.createDataFrame(docs + [docs[1], (None, None, None, None, None), (99, "", "en", "s", 1)], DOCS)
    labels = spark.createDataFrame([(1, None), (2, 1), (2, 0), (None, 1)], "doc_id long, quality int")
    out = quality.quality_rules(df, labels).collect()
    assert len(out) == 43 and sum(r.kept for r in out) == 41
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.quality_rules(df.limit(0), none).count() == 0


def test_query_is_as_plain_python(spark):
    """All documents: the cutoffs of every stratum and the verdicts, from counts and exact tails in plain Python."""
    from tests.conftest import SF
    from vigilake.llm import queries
    from vigilake.llm.common import table

    sf = SF.replace("0.001", "0.1")
    docs = {r.doc_id: r for r in table(spark, sf, "documents").select("doc_id", "text", "lang").collect()}
    metrics = {i: brute(d.text) for i, d in docs.items()}
    failed = {i: m[0] < 20 or 100 * m[5] > 30 * m[0] for i, m in metrics.items()}
    marks = {}
    for r in table(spark, sf, "labels").filter("quality IS NOT NULL").collect():
        marks[r.doc_id] = min(marks.get(r.doc_id, 1), r.quality)

    def value(rule, m):
        n, chars, symbols, lines, dups, repeats = m
        return {"symbols": lambda: symbols / chars, "dup_lines": lambda: dups / lines, "repeats": lambda: repeats / n, "word_length": lambda: abs(math.log(chars / n / 5))}[rule]() if n else None

    strata = {docs[i].lang for i in marks if i in docs and not failed[i]}
    cutoffs = {}
    for lang in strata:
        held = [(metrics[i], g == 1) for i, g in marks.items() if i in docs and not failed[i] and docs[i].lang == lang]
        n = sum(g for _, g in held)
        for rule, (_, cuts) in quality.RULES.items():
            best = None
            for step, cut in enumerate(cuts):
                good, bad = (sum(value(rule, m) > cut for m, g in held if g is want) for want in (True, False))
                p = tail(good, n, 0.0125) if n and good < n * 0.0125 else 1
                if p > 0.1 / len(quality.RULES) / len(strata):
                    break
                if bad - good > 0 and (best is None or bad - good > best[0]):
                    best = (bad - good, cut)
            if best:
                cutoffs[lang, rule] = best[1]
    got = {r.doc_id: r for r in queries.op7_quality_rules(spark, sf).collect()}
    assert cutoffs and set(got) == set(docs)
    for i, d in docs.items():
        rules = [] if failed[i] else [r for r in quality.RULES if (d.lang, r) in cutoffs and metrics[i][0] and value(r, metrics[i]) > cutoffs[d.lang, r]]
        assert (got[i].base_failed, got[i].failed_rules, got[i].kept) == (failed[i], ",".join(rules), not failed[i] and not rules), i
    assert any(r.failed_rules for r in got.values())
