"""Scores against plain Python that follows the rules' text."""

import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from vigilake.operators import scoring

START = datetime.datetime(2026, 1, 1)
SCHEMA = "transaction_id string, customer_id string, seq long, transaction_timestamp timestamp, amount double, city string, device_id string, trusted_device_id string, merchant_risk string, is_blacklisted boolean, is_international boolean"


def row(i, s=0.0, amount=50.0, city="Pune", device="D", trusted="D", risk="LOW", black=False, foreign=False, who="C"):
    return (f"T{i}", who, i, START + datetime.timedelta(seconds=s), amount, city, device, trusted, risk, black, foreign)


def brute(rows, forced=False):
    out = {}
    for n, r in enumerate(rows):
        past = sorted((x for x in rows if x[1] == r[1] and (x[3], x[2]) < (r[3], r[2])), key=lambda x: (x[3], x[2]))
        near = lambda sec: sum(x[3] >= r[3] - datetime.timedelta(seconds=sec) for x in past)  # noqa: B023, E731
        hit = [
            r[4] > 100000,
            bool(past) and past[-1][5] == "Delhi" and r[5] == "London" and r[3] - past[-1][3] <= datetime.timedelta(minutes=20),
            r[6] != r[7],
            r[8] == "HIGH",
            bool(r[9]),
            bool(r[10]),
            near(30) >= 5,
            5 <= r[4] <= 20 and near(60) >= 3,
        ]
        names = [k for k, h in zip(scoring.WEIGHTS, hit) if h]
        score = min(100, sum(scoring.WEIGHTS[k] for k in names))
        reason = names[0] if names else "NORMAL"
        if forced and names:
            reason = max(names, key=scoring.WEIGHTS.get)
        out[r[0]] = (score, reason)
    return out


def scores(spark, rows, forced=False):
    df = scoring.fraud_scores(scoring.rule_flags(spark.createDataFrame(rows, SCHEMA)), F.lit(True) if forced else None)
    return {r.transaction_id: (r.fraud_score, r.fraud_reason) for r in df.collect()}


def test_edges(spark):
    assert scores(spark, [row(1, amount=100000.0), row(2, 9999, amount=100000.01)]) == {"T1": (0, "NORMAL"), "T2": (40, "HIGH_VALUE_TRANSACTION")}
    for gap, to, back, score in ((1200, "London", "Delhi", 50), (1201, "London", "Delhi", 0), (60, "Delhi", "London", 0)):
        assert scores(spark, [row(1, 0, city=back), row(2, gap, city=to)])["T2"][0] == score
    six = scores(spark, [row(i, i) for i in range(6)])
    assert (six["T4"][0], six["T5"]) == (0, (45, "VELOCITY_FRAUD"))
    for amount, score in ((5, 30), (20, 30), (4.99, 0), (20.01, 0)):
        assert scores(spark, [row(0), row(1, 20), row(2, 40), row(3, 60, amount=float(amount))])["T3"][0] == score
    heavy = [row(1, black=True, risk="HIGH", foreign=True)]
    assert scores(spark, heavy)["T1"] == (100, "HIGH_RISK_MERCHANT")
    assert scores(spark, heavy, True)["T1"] == (100, "BLACKLISTED_MERCHANT")
    assert scores(spark, [row(1, risk="HIGH", foreign=True)], True)["T1"] == (50, "HIGH_RISK_MERCHANT")
    assert scores(spark, [row(1, device=None), row(2, 99, device=None, trusted=None)]) == {"T1": (20, "NEW_DEVICE"), "T2": (0, "NORMAL")}
    lone = scores(spark, [row(1)], True)["T1"]
    assert lone[0] == scoring.WEIGHTS[lone[1]]


ROWS = st.lists(st.tuples(st.integers(0, 300), st.sampled_from([3.0, 5.0, 12.0, 20.0, 99.0, 150000.0]), st.sampled_from(["Delhi", "London", "Pune"]), st.sampled_from(["D", "E", None]), st.sampled_from(["LOW", "HIGH", None]), st.sampled_from([True, False, None]), st.sampled_from([True, False, None]), st.sampled_from(["A", "B"])), min_size=1, max_size=30)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(ROWS, st.booleans())
def test_same_as_plain_python(spark, drawn, forced):
    rows = [row(i, float(s), a, c, d, "D", r, b, f, w) for i, (s, a, c, d, r, b, f, w) in enumerate(drawn)]
    got, want = scores(spark, rows, forced), brute(rows, forced)
    if forced:
        got = {k: v for k, v in got.items() if want[k][0]}
        want = {k: v for k, v in want.items() if v[0]}
    assert got == want


def test_slices_of_time_change_no_flag(spark):
    """Rows around the ends of slices, a customer with most rows, rows without customer or time, and repeated rows."""
    length = scoring.HORIZON_SECONDS
    at = [k * length + d for k in range(1, 4) for d in (-1200, -1199.5, -60, -59, -30, -29, -3, -2, -1, 0, 0, 1, 2, 30, 31, 58, 1198)]
    rows = [row(i, float(s), [5.0, 12.0, 99.0][i % 3], ["Delhi", "London"][i % 2], who="C" if i % 9 else None) for i, s in enumerate(at)]
    rows += [row(900 + k, s, city=c, who="D") for k, (s, c) in enumerate(((length - 0.0, "Delhi"), (2.0 * length, "London"), (5.0 * length - 1, "Delhi"), (6.0 * length, "London")))]
    rows += [(*row(950, who="E")[:3], None, *row(950)[4:]), row(960, 5.0, who="F"), row(960, 5.0, who="F")]
    df = spark.createDataFrame(rows, SCHEMA)
    names = [r.lower() for r in scoring.WEIGHTS]
    found = {n: sorted(tuple(r) for r in scoring.rule_flags(df, n).select("transaction_id", *names).collect()) for n in (length, 2 * length, 10**9)}
    assert len(found[length]) == len(rows) and found[length] == found[2 * length] == found[10**9]
    want = brute([r for r in rows if r[3] is not None])
    timed = scoring.fraud_scores(scoring.rule_flags(df.filter("transaction_timestamp IS NOT NULL"), length)).collect()
    assert {r.transaction_id: (r.fraud_score, r.fraud_reason) for r in timed} == want
    assert {"T901", "T903"} & {r[0] for r in found[length] if r[1 + names.index("impossible_travel")]} == {"T901"}  # 1200 s and 1201 s apart


def test_a_hot_customer_is_dealt_to_many_tasks(spark):
    rows = spark.range(3000).select(F.concat(F.lit("T"), "id").alias("transaction_id"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("C"), "id")).otherwise("hot").alias("customer_id"), F.col("id").alias("seq"), F.timestamp_seconds(F.col("id") * 600).alias("transaction_timestamp"), F.lit(9.0).alias("amount"), F.lit("Pune").alias("city"))
    plan = scoring.look_back_flags(rows.repartition("customer_id")).filter("customer_id = 'hot'")
    with_adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        shares = [r["count"] for r in plan.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", with_adaptive)
    assert sum(shares) == 1000 and len(shares) == 4 and max(shares) < 500
