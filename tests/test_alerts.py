import datetime

from pyspark.sql import functions as F

from vigilake import schemas
from vigilake.operators import alerts, watchlist, windows



def now():
    return F.lit("2026-01-05 10:00:00").cast("timestamp")



def rows(spark, schema, *given):
    return spark.createDataFrame([tuple((dict.fromkeys(schema.names) | g).values()) for g in given], schema)


def listing(spark, *given):
    return rows(spark, schemas.WATCHLIST, *given).withColumn("effective_from", F.to_timestamp("effective_from"))


def test_limit_is_strict_and_nulls_never_alert(spark):
    t = rows(spark, schemas.TRANSACTION, *[{"transaction_id": f"T{i}", "customer_id": c, "amount": a} for i, (c, a) in enumerate([("C", 10.0), ("C", 10.01), ("C", None), ("N", 99.0), ("X", 99.0), (None, 99.0), ("C", float("nan"))])])
    c = rows(spark, schemas.CUSTOMER, {"customer_id": "C", "transaction_limit": 10.0, "first_name": "A"}, {"customer_id": "N"})
    got = alerts.high_value_alerts(t, c, now())
    assert sorted((r.alert_id, r.customer_name) for r in got.collect()) == [("ALERT-T1", "A"), ("ALERT-T6", "A")]
    assert len(got.columns) == 19


def test_duplicate_customers_fan_out(spark):
    t = rows(spark, schemas.TRANSACTION, {"transaction_id": "T", "customer_id": "C", "amount": 11.0})
    c = rows(spark, schemas.CUSTOMER, *[{"customer_id": "C", "transaction_limit": 10.0}] * 2)
    assert alerts.high_value_alerts(t, c, now()).count() == 2


def test_cards(spark):
    t = rows(spark, schemas.TRANSACTION, {"transaction_id": "T1", "card_number": "4", "customer_id": "C", "transaction_timestamp": datetime.datetime(2026, 1, 1)}, {"transaction_id": "T2", "card_number": None}, {"transaction_id": None, "card_number": "5"})
    w = listing(spark, {"watchlist_id": "W1", "entity_id": "4", "status": "INACTIVE", "effective_from": "2030-01-01"}, {"watchlist_id": "W2", "entity_id": "4"}, {"watchlist_id": "W", "entity_id": "5"}, {"watchlist_id": "W0", "entity_id": None})
    c = rows(spark, schemas.CUSTOMER, {"customer_id": "other"})
    got = alerts.fraud_card_alerts(t, w, c, now())
    assert sorted((r.alert_id, r.customer_email, r.customer_name) for r in got.collect()) == [("FRAUD-T1-W1", None, ""), ("FRAUD-T1-W2", None, ""), ("FRAUD-W", None, "")]
    assert len(got.columns) == 32
    assert alerts.fraud_card_alerts(t, w, c, now(), retention="10 MINUTES").count() == 0


def test_windows(spark):
    t = spark.createDataFrame([(datetime.datetime(2026, 1, 1, 12, 1),), (None,)], "transaction_timestamp timestamp")
    one = windows.per_minute(t).collect()
    assert [(r.window_start.minute, r.window_end.minute, r.transaction_count) for r in one] == [(1, 2, 1)]
    assert sorted(r.window_start.minute for r in windows.five_minutes_sliding(t).collect()) == [0, 1, 57, 58, 59]
    assert [r.window_start.minute for r in windows.latest(windows.five_minutes_sliding(t), 2).collect()] == [1, 0]


def test_resume(spark, tmp_path):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "watchlist_id string")
    seed = ids(*[f"WL{i:06d}" for i in range(1, 6)], "bad", None)
    assert sorted(r[0] for r in watchlist.still_to_send(seed, ids("WL000003", "x", None)).collect()) == ["WL000004", "WL000005"]
    assert watchlist.still_to_send(seed, ids()).count() == 5
    watchlist.write_drip(seed.filter("watchlist_id LIKE 'WL%'"), str(tmp_path / "d"))
    assert len(list((tmp_path / "d").glob("*.json"))) == 5
