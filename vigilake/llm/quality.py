"""Quality rules with risk-controlled thresholds (operator 7); DataFrame functions only.

Base metrics are taken from each whole text in its own row, without a shuffle; windows of words are compared by nested
64-bit hashes, so they are exact up to a collision within one text. Cutoffs for
the learned rules come from labelled holdout documents of good quality: for each stratum and
rule, cutoffs are tried from the mildest to the strictest, as long as the exact binomial tail
refutes "more than `risk` of good documents fall". Confidence is shared out over strata and
rules (Bonferroni); along the fixed order of cutoffs no further correction is needed. `risk` is
shared out over rules, so that all rules together keep to it. Among the cutoffs so found safe,
that one is taken which rejects the most bad holdout documents less the good ones it costs; a
rule that catches no more bad than good documents is left out, so that good ones are left alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake.llm.common import materialize, words

SYMBOLS = "#*$%&|<>"
#: A character that belongs to a word.
NO_SPACE = "[^\\x20\\x09-\\x0D]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: Each learned rule: its metric and its cutoffs, the mildest first; a document falls if the metric is above.
RULES: dict[str, tuple[str, list[float]]] = {
    "symbols": ("1.0D * n_symbols / word_chars", [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.12, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02]),
    "dup_lines": ("1.0D * n_dup_lines / n_lines", [0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05]),
    "repeats": ("1.0D * n_repeat_words / n_words", [0.3, 0.28, 0.26, 0.24, 0.22, 0.2, 0.18, 0.16, 0.14, 0.12, 0.1, 0.08, 0.06, 0.04]),
    "word_length": ("abs(ln(1.0D * word_chars / n_words / 5))", [2.0, 1.8, 1.6, 1.4, 1.2, 1.1, 1.0, 0.9, 0.8, 0.7, 0.65, 0.6, 0.55, 0.5]),
}
#: Cutoff tables up to so many strata are broadcast (some 100 bytes each); beyond, they are joined by shuffle.
MAX_BROADCAST_STRATA = 10_000


def text_metrics(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep columns and n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (long).

    Null and empty texts count as no words. A repeated row gives a repeated row. Other columns,
    whatever their names, are left out."""
    names = [f"__k{i}" for i in range(len(keep))]
    t = docs.select(*[F.col(c).alias(k) for k, c in zip(names, keep)], F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    w = t.select(*names, "t", words(F.col("t")).alias("w"), F.filter(F.split("t", "\n"), lambda x: x.rlike(NO_SPACE)).alias("lines"))
    two = w.select(
        *names,
        "w",
        F.length(F.concat_ws("", "w")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _pairs("w", 1).alias("two"),
    )
    four = two.withColumn("n", F.size("w")).withColumn("four", _pairs("two", 2))
    # A window that repeats brings along repeats of its five runs of four words; other texts end here.
    some = (F.col("n") >= WINDOW) & (F.size("four") - F.size(F.array_distinct("four")) > WINDOW // 2)
    eight = four.withColumn("g", F.when(some, F.slice(_pairs("four", 4), F.lit(1), F.col("n") - (WINDOW - 1))))
    s = eight.withColumn("s", F.when(F.size("g") > F.size(F.array_distinct("g")), F.sort_array(F.transform("g", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    # Positions of windows that occur again, in order; each covers words up to the next one, eight at most.
    same = lambda v, i: F.coalesce(F.get("s", i)["x"] == v["x"], F.lit(False))
    p = s.withColumn("p", F.sort_array(F.transform(F.filter("s", lambda v, i: same(v, i - 1) | same(v, i + 1)), lambda v: v["i"])))
    step = F.transform("p", lambda v, i: F.least(F.lit(WINDOW), F.coalesce(F.get("p", i + 1) - v, F.lit(WINDOW))))
    covered = F.coalesce(F.aggregate(step, F.lit(0), lambda a, b: a + b), F.lit(0)).cast("long")
    return p.select(*[F.col(k).alias(c) for k, c in zip(names, keep)], F.col("n").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_lines", "n_dup_lines", covered.alias("n_repeat_words"))


def _pairs(values: str, apart: int) -> Column:
    """For each place of the array, a hash of its value and the one `apart` places on (the last places lack theirs)."""
    return F.zip_with(values, F.slice(values, F.lit(apart + 1), F.size(values)), lambda x, y: F.xxhash64(x, y))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _log_gamma(x: Column) -> Column:
    """ln Gamma(x), x >= 1, by Stirling's series at x + 8 (error below 1e-12)."""
    y = x + 8
    back = F.lit(0.0)
    for i in range(8):
        back = back + F.log(x + i)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - back


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p); 1 where k >= n * p, which no test needs more exactly.

    Below the mean the terms fall as they go down from k; those further than 12 deviations off are nothing."""
    k, n = k.cast("double"), n.cast("double")
    top = F.exp(_log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p))
    far = F.least(k, F.ceil(12 * F.sqrt(n)) + 50).cast("int")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def add(a: Column, i: Column) -> Column:
        at = k - i + 1
        term = a["term"] * at * (1 - p) / ((n - at + 1) * p)
        return F.struct(term.alias("term"), (a["sum"] + term).alias("sum"))

    tail = top * F.aggregate(F.when(far > 0, F.sequence(F.lit(1), far)).otherwise(F.array().cast("array<int>")), start, add, lambda a: a["sum"])
    return F.when((n == 0) | (k >= n * p), F.lit(1.0)).otherwise(F.least(tail, F.lit(1.0)))


def metric(rule: str) -> Column:
    """The rule's metric; null where it has no meaning (no words)."""
    return F.when(F.col("n_words") > 0, F.expr(RULES[rule][0]))


def risk_cutoffs(holdout: DataFrame, risk: float = 0.05, delta: float = 0.1) -> DataFrame:
    """stratum, rule, cutoff, n (good holdout documents), rejected, p_value; no row where no cutoff is safe and of use.

    holdout: columns of text_metrics, stratum and good (boolean), for labelled documents that pass the base
    rules. With probability 1 - delta, in every stratum at most `risk` of good documents are rejected by all
    rules together. A null stratum is a stratum of its own. Counts are summed before any shuffle."""
    each = risk / len(RULES)
    steps = [(r, i, float(c)) for r, (_, cuts) in RULES.items() for i, c in enumerate(cuts)]
    falls = lambda r, c, good: F.sum((F.col("good") == good).cast("long") * F.coalesce(metric(r) > c, F.lit(False)).cast("long"))
    counts = [falls(r, c, g).alias(f"{r}_{i}_{g}") for r, i, c in steps for g in (True, False)]
    by = materialize(holdout.groupBy("stratum").agg(F.count(F.when(F.col("good"), 1)).alias("n"), *counts), "holdout")
    strata = by.count()
    rows = [F.struct(F.lit(r).alias("rule"), F.lit(i).alias("step"), F.lit(c).alias("cutoff"), F.col(f"{r}_{i}_True").alias("rejected"), F.col(f"{r}_{i}_False").alias("bad")) for r, i, c in steps]
    tests = by.select("stratum", "n", F.inline(F.array(*rows))).withColumn("p_value", binomial_tail(F.col("rejected"), F.col("n"), each))
    tests = tests.withColumn("safe", F.col("p_value") <= delta / len(RULES) / max(1, strata))
    case = F.struct((F.col("bad") - F.col("rejected")).alias("gain"), (-F.col("step")).alias("mild"), "step", "cutoff", "n", "rejected", "p_value")
    best = tests.groupBy("stratum", "rule").agg(F.min(F.when(~F.col("safe"), F.col("step"))).alias("stop"), F.collect_list(case).alias("all"))
    best = best.withColumn("best", F.array_max(F.filter("all", lambda x: (F.col("stop").isNull() | (x["step"] < F.col("stop"))) & (x["gain"] > 0))))
    return best.filter("best IS NOT NULL").select("stratum", "rule", *[f"best.{c}" for c in ("cutoff", "n", "rejected", "p_value")])


def learn_cutoffs(metrics: DataFrame, labels: DataFrame, risk: float = 0.05, delta: float = 0.1) -> DataFrame:
    """stratum, cuts (map of rule to cutoff), from the labelled rows of metrics (doc_id, stratum, text_metrics, base_failed).

    labels: doc_id and quality (1 good). A document that has several or contradicting labels counts as good if all
    of them say so; null labels say nothing; a null doc_id is never labelled. Where labels are few or none, no
    cutoff is safe and only the base rules reject."""
    marks = labels.filter("quality IS NOT NULL").groupBy("doc_id").agg((F.min("quality") >= 1).alias("good"))
    cuts = risk_cutoffs(metrics.filter(~F.col("base_failed")).join(marks, "doc_id"), risk, delta)
    return materialize(cuts.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cuts")), "cutoffs")


def judge(metrics: DataFrame, cuts: DataFrame, stratum: str) -> DataFrame:
    """metrics with base_failed, failed_rules (array of the learned rules) and kept. Column `stratum` names each row's stratum, null included."""
    side = cuts.select(F.col("stratum").alias("__s"), F.col("cuts").alias("__cuts"))
    few = len(side.select("__s").take(MAX_BROADCAST_STRATA + 1)) <= MAX_BROADCAST_STRATA
    both = metrics.withColumn("base_failed", base_failed()).join(F.broadcast(side) if few else side, F.col(stratum).eqNullSafe(F.col("__s")), "left")
    fails = [F.when(metric(r) > F.try_element_at("__cuts", F.lit(r)), F.lit(r)) for r in RULES]
    both = both.withColumn("failed_rules", F.when(F.col("base_failed"), F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*fails))))
    return both.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop("__s", "__cuts")


def quality_rules(docs: DataFrame, labels: DataFrame, stratum_col: str = "lang", risk: float = 0.05, delta: float = 0.1) -> DataFrame:
    """A row for each document: doc_id, stratum, text_metrics, base_failed, failed_rules, kept. Empty tables give empty results."""
    m = materialize(text_metrics(docs.select("doc_id", "text", F.col(stratum_col).alias("stratum")), keep=("doc_id", "stratum")).withColumn("base_failed", base_failed()), "quality")
    return judge(m, learn_cutoffs(m, labels, risk, delta), "stratum")


def quality_filter(docs: DataFrame, labels: DataFrame, stratum_col: str = "lang", risk: float = 0.05, delta: float = 0.1) -> DataFrame:
    """The rows of docs that are kept, with their columns. Texts are measured once, written beside their metrics and never shuffled."""
    names = [f"__c{i}" for i in range(len(docs.columns))]
    own = dict(zip(docs.columns, names))
    m = materialize(text_metrics(docs.toDF(*names), own["text"], tuple(names)).withColumn("base_failed", base_failed()), "quality")
    cuts = learn_cutoffs(m.withColumnsRenamed({own["doc_id"]: "doc_id", own[stratum_col]: "stratum"}), labels, risk, delta)
    return judge(m, cuts, own[stratum_col]).filter("kept").select(*[F.col(n).alias(c) for c, n in own.items()])
