"""Mixing sources to target weights (operator 8): temperature mixing.

Source s with token share p(s) gets the weight p(s)^a, normalised. The exponent a is bisected (a pass evaluates
31 points, five bisections at once) until the weights' entropy meets a target, or until no source repeats more
often than a limit. Weights are then realised: a source's documents go by seeded permutations, one for each
epoch, until the source's token budget is spent, and copies are laid out over blocks of BLOCK_TOKENS tokens in
which every source has its share; a block is permuted in itself.

Positions within a permutation are token sums in the order of a hash. They are taken in two levels, sums over
hash ranges first and within a range then, so that a source with any share of the rows spreads over all tasks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from vigilake.llm.common import materialize, number_ties, row_key

BLOCK_TOKENS = 1 << 20
#: Documents of a hash range, on average, and how many ranges there are at least and at most (a power of two).
RANGE_ROWS, LEAST_RANGES, MOST_RANGES = 1 << 13, 1 << 6, 1 << 20
POINTS, PASSES = 31, 8
#: The table of sources is broadcast up to so many rows; beyond, it is joined by shuffle.
MAX_BROADCAST_SOURCES = 100_000
WORD = "[^\\x20\\x09-\\x0D]+"


@dataclass(frozen=True)
class Mix:
    """sources: source, tokens, share, weight, epochs (times it is gone over), one row each. rows: documents of all sources."""

    exponent: float
    budget: float
    sources: DataFrame
    small: bool
    rows: int


def count_tokens(text: Column) -> Column:
    """Words of a text; null: none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _solve(shares: DataFrame, wanted: float, measure: str) -> float:
    """The exponent in [0, 1] at which the measure, which falls as the exponent grows, comes down to `wanted`; an end of the range if it never does."""
    lo, hi = 0.0, 1.0
    ends = shares.agg(F.min("l"), F.max("l")).first()
    for _ in range(PASSES):
        points = [lo + (hi - lo) * i / (POINTS + 1) for i in range(POINTS + 2)]
        if measure == "entropy":
            sums = [c for a in points for c in (F.sum(F.exp(F.col("l") * a)), F.sum(F.exp(F.col("l") * a) * F.col("l")))]
            got = shares.agg(*[c.alias(f"c{i}") for i, c in enumerate(sums)]).first()
            values = [math.log(got[2 * i]) - a * got[2 * i + 1] / got[2 * i] for i, a in enumerate(points)]
        else:  # repeats: times the least source is gone over while the largest is gone over once
            values = [math.exp((ends[0] - ends[1]) * (a - 1)) for a in points]
        at = next((i for i, v in enumerate(values) if v <= wanted), None)
        if at is None:
            return hi
        if at == 0:
            return lo
        lo, hi = points[at - 1], points[at]
    return hi


def solve_mix(docs: DataFrame, source_col: str = "source", tokens_col: str = "n_tokens", target_entropy: float | None = None, max_repeats: float | None = None, budget: float | None = None) -> Mix:
    """Weights and epochs of each source.

    target_entropy (nats) or max_repeats decides the exponent; neither: 1. budget: tokens of the mix; None: as many
    as it takes to go over every source once at least, so that no document is lost. A null source is a source
    of its own. A source without tokens is gone over once. With no rows there are no sources."""
    by = materialize(docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(tokens_col).alias("tokens"), F.count(F.lit(1)).alias("rows")), "sources")
    count, total, rows = by.agg(F.count(F.lit(1)), F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("rows"), F.lit(0))).first()
    shares = by.filter("tokens > 0").withColumn("l", F.log(F.col("tokens") / float(total or 1)))
    exponent = 1.0
    if total and target_entropy is not None:
        exponent = _solve(shares, target_entropy, "entropy")
    elif total and max_repeats is not None:
        exponent = _solve(shares, max_repeats, "repeats")
    norm, top = shares.agg(F.coalesce(F.sum(F.exp(F.col("l") * exponent)), F.lit(1.0)), F.coalesce(F.max("l"), F.lit(0.0))).first()
    if budget is None:
        budget = total * norm * math.exp(top * (1 - exponent))  # the largest source, gone over once
    log_share = F.log(F.col("tokens") / float(total or 1))
    weight = F.when(F.col("tokens") > 0, F.exp(log_share * exponent) / norm).otherwise(F.lit(0.0))
    epochs = F.when(F.col("tokens") > 0, weight * float(budget) / F.col("tokens")).otherwise(F.lit(1.0))
    # A hair below a whole number is that number: the largest source's one epoch must not lose its last document.
    whole = F.when(F.abs(epochs - F.round(epochs)) < 1e-9, F.round(epochs)).otherwise(epochs)
    sources = by.select("source", "tokens", (F.col("tokens") / float(total or 1)).alias("share"), weight.alias("weight"), whole.alias("epochs"))
    return Mix(exponent, float(budget), sources, count <= MAX_BROADCAST_SOURCES, rows)


def countable(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, n_tokens, key, nth: what realise() needs of each row. key is a hash of the whole row; equal rows have numbers nth."""
    rows = docs.withColumn("__all", row_key(docs)).select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), count_tokens(F.col(text_col)).alias("n_tokens"), F.col("__all").alias("key"))
    return number_ties(materialize(rows, "counted"), key="__row", nth="nth").drop("__row")


def _place(seed: int, epoch: str, key: str, nth: str) -> Column:
    """A row's place in the permutation of an epoch: 0 to 2^63 - 1."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(epoch), F.col(key), F.col(nth)), 1)


def _join(docs: DataFrame, side: DataFrame, small: bool, source_col: str) -> DataFrame:
    """Rows with what the side has on their source (its __from)."""
    return docs.join(F.broadcast(side) if small else side, F.col(source_col).eqNullSafe(F.col("__from"))).drop("__from")


def realise(counted: DataFrame, mix: Mix, seed: int = 8, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id, source, n_tokens, epoch (from 0), block, slot (gapless from 0 in its block), place (in the epoch's permutation): a row for each copy.

    counted: of countable(). A source's last epoch ends with the document at which its budget is spent. Repeated and null
    ids have places of their own, by the rest of their row and their number among equal rows."""
    ranges = min(MOST_RANGES, max(LEAST_RANGES, 1 << (mix.rows // RANGE_ROWS).bit_length()))
    copies = _join(counted, mix.sources.select(F.col("source").alias("__from"), "tokens", "epochs"), mix.small, "source")
    copies = copies.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.ceil("epochs").cast("int") - 1))).withColumn("place", _place(seed, "epoch", "key", "nth"))
    copies = copies.filter("epochs > 0").withColumn("range", F.shiftrightunsigned("place", 64 - ranges.bit_length()))
    sums = copies.groupBy("source", "epoch", "range").agg(F.sum("n_tokens").alias("own"))
    before = sums.withColumn("before", F.coalesce(F.sum("own").over(W.partitionBy("source", "epoch").orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("own")
    inside = W.partitionBy("source", "epoch", "range").orderBy("place").rangeBetween(W.unboundedPreceding, -1)
    c = copies.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("c")
    b = before.alias("b")
    c = c.join(b, F.expr("c.source <=> b.source AND c.epoch = b.epoch AND c.range = b.range")).select("c.*", "b.before")
    at = F.col("before") + F.col("inside")
    spent = F.col("epoch") + F.when(F.col("tokens") > 0, at / F.col("tokens")).otherwise(F.lit(0.0))
    kept = c.withColumn("spent", spent).filter("spent < epochs")
    blocks = max(1, math.ceil(mix.budget / block_tokens))
    kept = kept.withColumn("block", F.least(F.floor(F.col("spent") / F.col("epochs") * blocks), F.lit(blocks - 1)))
    slot = F.row_number().over(W.partitionBy("block").orderBy(F.xxhash64(F.lit(seed + 1), "key", "nth", "epoch"), "key", "nth", "epoch")) - 1
    return kept.select("doc_id", "source", "n_tokens", "epoch", "block", slot.alias("slot"), "place")


def apply_mix(docs: DataFrame, mix: Mix, plan: DataFrame, seed: int = 8, source_col: str = "source") -> DataFrame:
    """The rows of docs, each as often as the plan (of realise(countable(docs))) has it, with all columns; only the texts of equal rows are shuffled.

    A copy is in the plan if its epoch is whole or its place comes before the last epoch's end, so the end of each
    source's last epoch is all that has to be known."""
    ends = plan.groupBy("source").agg(F.max_by("place", F.struct("epoch", "place")).alias("__end"), F.max("epoch").alias("__last"))
    ends = materialize(ends.withColumnRenamed("source", "__from"), "ends")
    rows = _join(number_ties(docs), ends, mix.small, source_col)
    taken = (F.col("__epoch") < F.col("__last")) | (_place(seed, "__epoch", "__key", "__nth") <= F.col("__end"))
    return rows.withColumn("__epoch", F.explode(F.sequence(F.lit(0), "__last"))).filter(taken).select(*docs.columns)
