"""Fraud scoring: eight weighted rules over each transaction and its customer's earlier ones.

A customer's rows are ordered by event time, and rows of one time by `seq`. Rules that look back are lag()
functions of one window; the score is then plain expressions. No rule looks further back than HORIZON_SECONDS, so a
customer's rows are cut into slices of time, and those at the end of a slice stand at the start of the next one as well.
Scoring costs one shuffle, on customer and slice: a customer with a third of all rows is the work of as many tasks as
its rows have slices, and lag() holds five rows of one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from vigilake.functions import text

# Weights of the rules, in the order in which they are evaluated.
WEIGHTS = {
    "HIGH_VALUE_TRANSACTION": 40,
    "IMPOSSIBLE_TRAVEL": 50,
    "NEW_DEVICE": 20,
    "HIGH_RISK_MERCHANT": 25,
    "BLACKLISTED_MERCHANT": 60,
    "INTERNATIONAL_TRANSACTION": 25,
    "VELOCITY_FRAUD": 45,
    "CARD_TESTING": 30,
}
HIGH_VALUE_AMOUNT = 100_000
TRAVEL_FROM, TRAVEL_TO, TRAVEL_MINUTES = "Delhi", "London", 20
VELOCITY_COUNT, VELOCITY_SECONDS = 5, 30
TESTING_COUNT, TESTING_SECONDS, TESTING_LOW, TESTING_HIGH = 3, 60, 5, 20
NORMAL = "NORMAL"
#: How far back a rule looks at most.
HORIZON_SECONDS = max(TRAVEL_MINUTES * 60, VELOCITY_SECONDS, TESTING_SECONDS)
LOOK_BACK = ("impossible_travel", "velocity_fraud", "card_testing")


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def look_back_flags(transactions: DataFrame, slice_seconds: int = 7200) -> DataFrame:
    """transactions with the flags of LOOK_BACK, from each customer's earlier rows; rows without a customer count as one customer's.

    slice_seconds: length of a slice, HORIZON_SECONDS at least. Of each slice the last HORIZON_SECONDS are shuffled twice, the
    second time only with what the rules look at; whatever the length, the flags are the same."""
    if slice_seconds < HORIZON_SECONDS:
        raise ValueError(f"a slice must have {HORIZON_SECONDS} seconds at least")
    seen = ("customer_id", "transaction_timestamp", "seq", "city")
    ts, length, horizon = F.unix_micros("transaction_timestamp"), slice_seconds * 1_000_000, HORIZON_SECONDS * 1_000_000
    place = F.pmod(ts, F.lit(length))
    own = ts - place
    dealt = transactions.withColumn("__slice", F.explode(F.when(place >= length - horizon, F.array(own, own + length)).otherwise(F.array(own))))
    dealt = dealt.withColumn("__own", F.col("__slice").eqNullSafe(own))
    dealt = dealt.withColumns({c: F.when(F.col("__own"), F.col(c)) for c in transactions.columns if c not in seen}).repartition("customer_id", "__slice")
    w = W.partitionBy("customer_id", "__slice").orderBy("transaction_timestamp", "seq")
    within = lambda n, seconds: F.lag(ts, n).over(w) >= ts - seconds * 1_000_000
    travel = (F.lag("city").over(w) == TRAVEL_FROM) & (F.col("city") == TRAVEL_TO) & (F.abs(ts - F.lag(ts).over(w)) <= TRAVEL_MINUTES * 60_000_000)
    flags = {
        "impossible_travel": _flag(travel),
        "velocity_fraud": _flag(within(VELOCITY_COUNT, VELOCITY_SECONDS)),
        "card_testing": _flag(F.col("amount").between(TESTING_LOW, TESTING_HIGH) & within(TESTING_COUNT, TESTING_SECONDS)),
    }
    return dealt.withColumns(flags).filter("__own").drop("__slice", "__own")


def rule_flags(transactions: DataFrame, slice_seconds: int = 7200) -> DataFrame:
    """transactions with a boolean column for each rule, named as the rule in lower case.

    Needs customer_id, transaction_timestamp, seq, amount, city, device_id, trusted_device_id, merchant_risk,
    is_blacklisted and is_international. An unknown value triggers nothing, but for a device that differs from the
    trusted one in being known or not. slice_seconds: as for look_back_flags()."""
    return row_flags(look_back_flags(transactions, slice_seconds))


def row_flags(transactions: DataFrame) -> DataFrame:
    """transactions with the flags of the rules that look at a row alone."""
    return transactions.withColumns(
        {
            "high_value_transaction": _flag(F.col("amount") > HIGH_VALUE_AMOUNT),
            "new_device": ~F.col("device_id").eqNullSafe(F.col("trusted_device_id")),
            "high_risk_merchant": _flag(F.col("merchant_risk") == "HIGH"),
            "blacklisted_merchant": _flag(F.col("is_blacklisted")),
            "international_transaction": _flag(F.col("is_international")),
        }
    )


def _total() -> Column:
    total = F.lit(0)
    for rule, weight in WEIGHTS.items():
        total = total + F.when(F.col(rule.lower()), weight).otherwise(0)
    return total


def first_reason() -> Column:
    return F.coalesce(*[F.when(F.col(r.lower()), F.lit(r)) for r in WEIGHTS], F.lit(NORMAL))


def heaviest_reason() -> Column:
    """The triggered rule of most weight; of several, the first."""
    return F.array_max(F.array_compact(F.array(*[F.when(F.col(r.lower()), F.struct(F.lit(w).alias("w"), F.lit(-i).alias("i"), F.lit(r).alias("r"))) for i, (r, w) in enumerate(WEIGHTS.items())])))["r"]


def fraud_scores(flagged: DataFrame, forced: Column | None = None, seed: int = 42, key: str = "transaction_id") -> DataFrame:
    """flagged with fraud_score (0 to 100) and fraud_reason.

    The reason is the first triggered rule. Where `forced` holds it is the heaviest one; if none is triggered, one of
    all rules, chosen by the seed and the row's key, counts as triggered."""
    reason, score = first_reason(), _total()
    if forced is not None:
        forced = _flag(forced)
        chosen = text.pick(text.uniform(seed, "rule", F.col(key)), list(WEIGHTS))
        weight = F.coalesce(*[F.when(chosen == r, w) for r, w in WEIGHTS.items()])
        none = score == 0
        score = F.when(forced & none, weight).otherwise(score)
        reason = F.when(forced, F.when(none, chosen).otherwise(heaviest_reason())).otherwise(reason)
    return flagged.withColumn("fraud_score", F.least(F.lit(100), score)).withColumn("fraud_reason", reason)


def score(transactions: DataFrame, customers: DataFrame, merchants: DataFrame, forced: Column | None = None, seed: int = 42) -> DataFrame:
    """Scores of transactions, whose customer and merchant are looked up; either may be unknown. Ids must be unique in both tables.

    Earlier rows are looked at first: the joins then stand last, where a hot customer's rows may be split for them."""
    c = customers.select("customer_id", "trusted_device_id")
    m = merchants.select("merchant_id", "merchant_risk", "is_blacklisted")
    return fraud_scores(row_flags(look_back_flags(transactions).join(c, "customer_id", "left").join(m, "merchant_id", "left")), forced, seed)
