import datetime
import json

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilake import schemas
from vigilake.operators import expectations as E
from vigilake.operators import refine
from vigilake.sources import files



def now():
    return F.lit("2026-01-05 10:00:00").cast("timestamp")

GOOD = {"transaction_id": "TXN1", "customer_id": "C", "card_number": "4", "merchant_id": "M", "amount": 5.0}


def envelope(spark, values):
    rows = [(None, None if v is None else bytearray(v.encode()), "t", 0, i, datetime.datetime(2026, 1, 1), 0) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, schemas.ENVELOPE)


def silver(spark, values, observe=None):
    return refine.silver_transactions(refine.bronze_transactions(envelope(spark, values), now()), now(), observe)


def test_what_is_no_transaction_is_dropped(spark):
    values = ["{broken", "", None, "[1]", "7", *[json.dumps({k: v for k, v in GOOD.items() if k != gone}) for gone in ("transaction_id", "customer_id", "card_number", "merchant_id")], json.dumps(GOOD)]
    assert [r.kafka_offset for r in silver(spark, values).collect()] == [9]


def test_fields_that_do_not_fit(spark):
    v = [json.dumps(GOOD | {"amount": "12.5", "transaction_id": 77, "unknown": 1, "transaction_timestamp": "2026-01-05T10:00:00Z"})]
    r = silver(spark, v).first()
    assert (r.amount, r.transaction_id, r.transaction_timestamp) == (None, "77", datetime.datetime(2026, 1, 5, 10))
    assert len(r) == 22


def test_amounts_warn_only(spark):
    o = Observation()
    rows = silver(spark, [json.dumps(GOOD | {"amount": a}) for a in (-1, 0, None, 3)], o)
    assert rows.count() == 4
    assert o.get["valid_amount"] == 3 and o.get["rows"] == 4 and o.get["valid_card_number"] == 0


def test_expectation_fails_the_run(spark):
    df = E.apply(spark.range(3), [E.Expectation("small", "id < 2", E.FAIL)])
    try:
        df.collect()
    except Exception as e:
        assert "small" in str(e)
    else:
        raise AssertionError("no failure")


def test_watchlist(spark):
    row = {c: "x" for c in schemas.WATCHLIST.names}
    rows = [row | {"watchlist_id": "wl1", "entity_id": "ab", "risk_level": "high", "action": "block", "status": "active", "effective_from": t} for t in ("05-jan-2026 10:00:00", "5-Jan-2026 10:00:00", "soon", None)]
    bronze = refine.bronze_watchlist(spark.createDataFrame([tuple(r.values()) for r in rows], schemas.WATCHLIST).withColumn("source_file", F.lit("f")), now())
    assert len(bronze.columns) == 16
    out = refine.silver_watchlist(bronze, now()).collect()
    assert [r.effective_from for r in out] == [datetime.datetime(2026, 1, 5, 10), None, None, None]
    assert (out[0].watchlist_id, out[0].entity_id, out[0].risk_level, out[0].action, out[0].status, out[0].watch_type) == ("WL1", "AB", "HIGH", "BLOCK", "active", "x")
    assert len(out[0]) == 16


def test_customers(spark):
    row = {f.name: None for f in schemas.CUSTOMER.fields}
    rows = [tuple((row | {"customer_id": i, "account_open_date": d}).values()) for i, d in ((None, "2020-01-01"), ("C1", "2020-02-30"), ("C2", "2020-02-29"))]
    out = refine.silver_customers(spark.createDataFrame(rows, schemas.CUSTOMER), now()).orderBy("customer_id").collect()
    assert [(r.customer_id, r.account_open_date) for r in out] == [("C1", None), ("C2", datetime.date(2020, 2, 29))]


def test_rescued(spark):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.IntegerType())])
    lines = ['{"a": "x", "n": 1}', '{"a": "x", "n": "many", "new": true}', "nonsense", None, '{"n": null}']
    got = files.rescued(spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string"), schema).orderBy("i").collect()
    assert [(r.a, r.n) for r in got] == [("x", 1), ("x", None), (None, None), (None, None), (None, None)]
    rescued = [r._rescued_data and json.loads(r._rescued_data) for r in got]
    assert rescued == [None, {"n": "many", "new": "true"}, {"_corrupt_record": "nonsense"}, None, None]


def test_sources(spark, tmp_path):
    (tmp_path / "w.csv").write_text("entity_id,n\n0012,3\n")
    t = T.StructType([T.StructField("entity_id", T.StringType()), T.StructField("n", T.IntegerType())])
    assert tuple(files.csv_table(spark, str(tmp_path / "w.csv"), t).first()) == ("0012", 3)
    assert files.listing(spark, str(tmp_path), "*.csv").select("length").first()[0] == 19


def test_messages_are_parsed_once(spark):
    from vigilake.plans import catalog

    plan = catalog.QUERIES["silver_transactions"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_rescued_types_and_one_parse(spark):
    """Numbers in quotes, fractions for whole numbers, nested values, times, fields twice; the line is parsed once."""
    schema = T.StructType().add("s", "string").add("l", "long").add("d", "double").add("b", "boolean").add("t", "timestamp").add("o", T.StructType().add("x", "integer")).add("a.b", "integer")
    lines = [
        '{"s": 5, "l": 5, "d": 5, "b": true, "t": "2024-01-02T03:04:05.123456Z", "o": {"x": 1}, "a.b": 7}',
        '{"s": {"k": [1]}, "l": 5.5, "d": "5", "b": "true", "t": 5, "o": 3}',
        '{"l": 1, "l": 2}',
        "[1]",
        "",
        '{"z": {"k": [1, "x"]}, "y": 1.50}',
    ]
    df = files.rescued(spark.createDataFrame([(i, x, "kept") for i, x in enumerate(lines)], "i int, value string, _rescued_data string").withColumnRenamed("i", "no.1"), schema)
    assert df.columns == [*schema.names, "_rescued_data", "no.1", "value"]
    got = sorted(df.collect(), key=lambda r: r["no.1"])
    first = got[0]
    assert (first.s, first.l, first.d, first.b, first.o.x, first["a.b"], first._rescued_data) == ("5", 5, 5.0, True, 1, 7, None) and first.t.microsecond == 123456
    assert got[1][:7] == ('{"k":[1]}', None, None, None, None, None, None)
    assert json.loads(got[1]._rescued_data) == {"l": "5.5", "d": "5", "b": "true", "t": "5", "o": "3"}
    assert json.loads(got[2]._rescued_data) == {"_corrupt_record": lines[2]} and json.loads(got[3]._rescued_data) == {"_corrupt_record": "[1]"} and got[4]._rescued_data is None
    assert json.loads(got[5]._rescued_data) == {"z": '{"k":[1,"x"]}', "y": "1.5"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.lower().count("parse_json") + plan.count("ParseJson") == 1 or plan.count("parseJson(") == 1, plan
    nothing = files.rescued(spark.createDataFrame([('{"q": 1}',)], "value string"), T.StructType())
    assert [r._rescued_data for r in nothing.collect()] == ['{"q":"1"}']
