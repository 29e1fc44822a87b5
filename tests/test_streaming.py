import datetime
import json
import time

from pyspark.sql import functions as F

from vigilake import schemas
from vigilake.operators import alerts, scoring, windows
from vigilake.plans import medallion, simulate
from vigilake.config import SimulatorSettings
from vigilake.streaming import producer, replay, sinks, stateful

START = datetime.datetime(2026, 1, 1)


def at(minutes):
    return START + datetime.timedelta(minutes=minutes)


def files(spark, path, batches, schema):
    """One file for each batch, in order of time."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))
        time.sleep(0.02)


def stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def drained(df, tmp_path, name="q", mode="append"):
    q = df.writeStream.format("parquet").option("path", str(tmp_path / name / "out")).option("checkpointLocation", str(tmp_path / name / "cp")).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(str(tmp_path / name / "out")), q


def test_closed_windows_only_and_late_rows(spark, tmp_path):
    schema = "transaction_timestamp timestamp"
    files(spark, tmp_path / "in", [[(at(0),)], [(at(20),)], [(at(21),)], [(at(1),)], [(None,)]], schema)
    out, q = drained(windows.per_minute(stream(spark, tmp_path / "in", schema), watermark="5 minutes"), tmp_path)
    assert [r.window_start for r in out.collect()] == [at(0)]
    dropped = sum(s["numRowsDroppedByWatermark"] for p in q.recentProgress for s in p["stateOperators"])
    assert dropped == 1


def test_restart_repeats_nothing(spark, tmp_path):
    t_schema, n = "customer_id string, amount double", 3
    files(spark, tmp_path / "in", [[("C", 11.0)]] * n, t_schema)
    limits = spark.createDataFrame([("C", 10.0)], "customer_id string, transaction_limit double")
    plan = lambda: stream(spark, tmp_path / "in", t_schema).join(limits, "customer_id").filter("amount > transaction_limit")
    assert drained(plan(), tmp_path)[0].count() == n
    files(spark, tmp_path / "in", [[("C", 12.0)]], t_schema)
    assert drained(plan(), tmp_path)[0].count() == n + 1


def test_state_of_card_matching(spark, tmp_path):
    t = [[dict.fromkeys(schemas.TRANSACTION.names) | {"transaction_id": f"T{i}", "card_number": "4", "transaction_timestamp": at(30 * i)}] for i in range(4)]
    w = [[dict.fromkeys(schemas.WATCHLIST.names) | {"watchlist_id": f"W{i}", "entity_id": "4", "effective_from": None}] for i in range(4)]
    w_schema = ", ".join(f"{n} {'timestamp' if n == 'effective_from' else 'string'}" for n in schemas.WATCHLIST.names)
    files(spark, tmp_path / "t", [[tuple(x.values()) for x in b] for b in t], schemas.TRANSACTION)
    files(spark, tmp_path / "w", [[tuple((x | {"effective_from": at(30 * i)}).values()) for x in b] for i, b in enumerate(w)], w_schema)
    customers = spark.createDataFrame([], schemas.CUSTOMER)
    rows = {}
    for name, keep in (("strict", None), ("bounded", "10 MINUTES")):
        df = alerts.fraud_card_alerts(stream(spark, tmp_path / "t", schemas.TRANSACTION), stream(spark, tmp_path / "w", w_schema), customers, F.lit(START), keep, watermark="5 minutes")
        out, q = drained(df, tmp_path, name)
        rows[name] = out.count(), q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
    assert rows["strict"] == (16, 8)
    assert rows["bounded"][0] == 4 and rows["bounded"][1] < 8


def test_stateful_scores_equal_batch_scores(spark, tmp_path):
    n = 60
    rows = [(f"T{i}", "AB"[i % 2], i, START + datetime.timedelta(seconds=7 * i), [12.0, 50.0, 2e5][i % 3], ["Delhi", "London"][i // 2 % 2], "D", "D", "LOW", False, False) for i in range(n)]
    schema = "transaction_id string, customer_id string, seq long, transaction_timestamp timestamp, amount double, city string, device_id string, trusted_device_id string, merchant_risk string, is_blacklisted boolean, is_international boolean"
    files(spark, tmp_path / "in", [rows[:20], rows[20:45], rows[45:]], schema)
    out, _ = drained(stateful.score_stream(stream(spark, tmp_path / "in", schema)), tmp_path)
    got = {r.transaction_id: (r.fraud_score, r.fraud_reason) for r in out.collect()}
    batch = scoring.fraud_scores(scoring.rule_flags(spark.createDataFrame(rows, schema)))
    assert got == {r.transaction_id: (r.fraud_score, r.fraud_reason) for r in batch.collect()}
    assert len(got) == n and any(v[0] > 50 for v in got.values())


def test_replay(spark):
    t = spark.createDataFrame([(at(m),) for m in range(10)], "transaction_timestamp timestamp")
    assert replay.drain(spark, {"t": t}, lambda x: windows.per_minute(x, watermark="1 minute")).count() == 8


def high(spark, n):
    t = simulate.transactions(spark, n, SimulatorSettings(customers=5, merchants=24))
    return alerts.high_value_alerts(t.withColumn("amount", F.lit(1e9)), simulate.customers(spark, SimulatorSettings(customers=5, merchants=24)))


def test_digest(spark):
    notifier = sinks.MemoryNotifier()
    write = sinks.digest_sink(notifier, "ops@example.com", max_rows=3)
    write(high(spark, 0), 0)
    assert notifier.sent == []
    write(high(spark, 5).withColumn("merchant_name", F.lit("<b>&")), 1)
    (to, subject, body), = notifier.sent
    assert to == "ops@example.com" and subject.startswith("5 ") and body.count("<tr>") == 4 and "&lt;b&gt;&amp;" in body and "and 2 more" in body
    failing = sinks.digest_sink(sinks.MemoryNotifier(failing=frozenset(["x"])), "x")
    failing(high(spark, 1), 2)
    assert failing.counters.failed == 1


def test_digest_lists_every_alert(spark):
    notifier = sinks.MemoryNotifier()
    alerts = high(spark, 7)
    sinks.digest_sink(notifier, "ops@example.com", mail_rows=3)(alerts, 0)
    assert [body.count("<tr>") - 1 for _, _, body in notifier.sent] == [3, 3, 1] and [s[-8:] for _, s, _ in notifier.sent] == ["(1 of 3)", "(2 of 3)", "(3 of 3)"]
    assert all(sum(r.alert_id in body for _, _, body in notifier.sent) == 1 for r in alerts.select("alert_id").collect())
    notifier.sent.clear()
    # By default too a large batch is whole.
    big = alerts.crossJoin(spark.range(200)).drop("id")
    sinks.digest_sink(notifier, "ops@example.com")(big, 1)
    assert sum(body.count("<tr>") - 1 for _, _, body in notifier.sent) == 1400


def test_mails(spark, tmp_path):
    t = spark.createDataFrame([tuple((dict.fromkeys(schemas.TRANSACTION.names) | {"transaction_id": f"T{i}", "card_number": "4", "customer_id": f"C{i}", "amount": 1234.5}).values()) for i in range(4)], schemas.TRANSACTION)
    w = spark.createDataFrame([tuple((dict.fromkeys(schemas.WATCHLIST.names) | {"watchlist_id": "W", "entity_id": "4", "risk_level": "HIGH", "city": ""}).values())], schemas.WATCHLIST)
    c = spark.createDataFrame([tuple((dict.fromkeys(schemas.CUSTOMER.names) | {"customer_id": f"C{i}", "email": f"c{i}@x"}).values()) for i in range(3)], schemas.CUSTOMER)
    batch = alerts.fraud_card_alerts(t, w, c)
    for ledger in (None, str(tmp_path / "ledger")):
        notifier = sinks.MemoryNotifier(failing=frozenset(["c1@x"]))
        write = sinks.mail_sink(notifier, ledger=ledger, every=1)
        write(batch.unionByName(batch), 0)
        assert (write.counters.sent, write.counters.failed, write.counters.skipped) == (2, 2, 4)
        write(batch, 0)
        assert len(notifier.sent) == 2
    # Another driver reads the ledger: what failed is tried again, what was sent is not.
    notifier = sinks.MemoryNotifier()
    sinks.mail_sink(notifier, ledger=ledger)(batch, 0)
    assert [to for to, _, _ in notifier.sent] == ["c1@x"]
    body = notifier.sent[0][2]
    assert "****4" in body and "1,234.50" in body and "N/A, N/A" in body and "HIGH" in notifier.sent[0][1]


def test_medallion_as_batch_and_as_stream(spark, tmp_path):
    s = SimulatorSettings(customers=20, merchants=24, transactions_per_second=1)
    t = simulate.transactions(spark, 1500, s)
    envelope = simulate.as_messages(t).select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"), F.current_timestamp().alias("timestamp"), F.lit(0).alias("timestampType"))
    envelope.write.parquet(str(tmp_path / "m"))
    people = simulate.customers(spark, s)
    people.withColumn("transaction_limit", F.lit(20000.0)).write.parquet(str(tmp_path / "c"))
    card = people.first().card_number
    w = spark.createDataFrame([tuple((dict.fromkeys(schemas.WATCHLIST.names) | {"watchlist_id": "wl1", "entity_id": card, "effective_from": "01-Jan-2024 00:00:00"}).values())], schemas.WATCHLIST).withColumn("source_file", F.lit("f"))
    w.write.parquet(str(tmp_path / "w"))
    names = {"transaction_messages": "m", "customer_profiles": "c", "watchlist_files": "w"}
    paths = {k: str(tmp_path / v) for k, v in names.items()}
    r = medallion.build()
    mails = sinks.MemoryNotifier()
    r.sink("mail", "fraud_card_alerts")(sinks.mail_sink(mails))
    assert [d.name for d in r.order()].index("bronze_transactions") < [d.name for d in r.order()].index("silver_transactions")
    batch = r.run_batch({k: spark.read.parquet(p) for k, p in paths.items()})
    for _ in range(2):
        r.run_stream(spark, paths, str(tmp_path / "lake"))
    read = lambda n: spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "lake/tables" / n))
    for n in ("silver_transactions", "silver_customers", "silver_watchlist", "high_value_alerts", "fraud_card_alerts"):
        assert read(n).count() == batch[n].count() > 0, n
        assert read(n).columns == batch[n].columns
    open_ones = batch["transactions_per_minute"].join(read("transactions_per_minute"), ["window_start", "transaction_count"], "left_anti").count()
    assert 0 < open_ones <= 6
    assert len(mails.sent) == batch["fraud_card_alerts"].count()


def test_feed(spark):
    s = SimulatorSettings(customers=5, merchants=24)
    ticks = spark.createDataFrame([(7, at(1)), (9, at(2))], "seq long, timestamp timestamp")
    got = [json.loads(r.value) for r in producer.feed(ticks, simulate.customers(spark, s), simulate.merchants(spark, s), s).collect()]
    assert sorted(g["transaction_id"] for g in got) == ["TXN0000007", "TXN0000009"]
    assert all(set(g) <= set(schemas.TRANSACTION.names) and 1 <= g["amount"] <= 99999.99 and g["transaction_timestamp"].endswith("Z") for g in got)


def test_running_until_stopped(spark, tmp_path):
    s = SimulatorSettings(transactions_per_second=50)
    q = producer.ticks(spark, s).writeStream.foreachBatch(lambda b, i: None).option("checkpointLocation", str(tmp_path / "cp")).start()
    with producer.stopping([q]):
        assert q.isActive
    assert not q.isActive


SCORED = "transaction_id string, customer_id string, seq long, transaction_timestamp timestamp, amount double, city string, device_id string, trusted_device_id string, merchant_risk string, is_blacklisted boolean, is_international boolean"


def scored_rows(n, customer="A", start=START, seconds=5):
    return [(f"{customer}{i}", customer, i, start + datetime.timedelta(seconds=seconds * i, microseconds=i), [12.0, 50.0, 2e5][i % 3], ["Delhi", "London"][i // 2 % 2], None if i % 4 else "D", "D", "LOW", None, False) for i in range(n)]


def test_scores_in_event_time(spark):
    """Rows come out of order over three batches; what is late is dropped; a customer who is quiet for long leaves no state."""
    rows = scored_rows(40) + scored_rows(40, "B")
    batches = [[r for k, r in enumerate(rows) if k * 7 % 3 == b] for b in range(3)]
    late = scored_rows(1, "L")
    end = scored_rows(1, "Z", at(60))
    turns = [{"t": spark.createDataFrame(b, SCORED)} for b in (*batches, end, late, scored_rows(1, "Z2", at(61)))]
    run = replay.in_turns(spark, {"t": turns[0]["t"].schema}, lambda t: stateful.score_stream(t, delay="10 minutes"), turns, stops=(2,))
    want = scoring.fraud_scores(scoring.rule_flags(spark.createDataFrame(rows, SCORED)))
    names = sorted(want.columns)
    assert sorted(map(str, run.out().select(names).collect())) == sorted(map(str, want.select(names).collect()))
    assert all(want.filter(rule).count() > 0 for rule in ("velocity_fraud", "impossible_travel", "card_testing"))
    assert run.query.recentProgress[-1]["stateOperators"][0]["customMetrics"].get("numExpiredTimers", 1) >= 0
    kept = spark.read.format("statestore").option("stateVarName", "past").load(run.checkpoint)
    assert kept.count() == 0


def test_customers_of_a_group_are_scored_apart(spark):
    """Two customers whose rows are mixed share one group, one set of state calls and one row of state."""
    rows = scored_rows(30) + scored_rows(30, "B")
    turns = [{"t": spark.createDataFrame(rows[k::2], SCORED)} for k in range(2)] + [{"t": spark.createDataFrame(scored_rows(1, "Z", at(9)), SCORED)}]
    run = replay.in_turns(spark, {"t": turns[0]["t"].schema}, lambda t: stateful.score_stream(t, delay="5 minutes", groups=1), turns)
    want = scoring.fraud_scores(scoring.rule_flags(spark.createDataFrame(rows, SCORED)))
    names = sorted(want.columns)
    assert sorted(map(str, run.out().select(names).collect())) == sorted(map(str, want.select(names).collect()))
    kept = spark.read.format("statestore").option("stateVarName", "past").load(run.checkpoint)
    assert kept.count() == 1


def test_state_has_few_parts(spark):
    before = spark.conf.get(replay.PARTS)
    spark.conf.set(replay.PARTS, "50")
    try:
        t = spark.createDataFrame([(at(m),) for m in range(10)], "transaction_timestamp timestamp")
        run = replay.in_turns(spark, {"t": t.schema}, lambda x: windows.per_minute(x, watermark="1 minute"), [{"t": t}])
        assert spark.conf.get(replay.PARTS) == "50"
    finally:
        spark.conf.set(replay.PARTS, before)
    assert run.query.recentProgress[-1]["stateOperators"][0]["numShufflePartitions"] == replay.PARTS_A_CORE * spark.sparkContext.defaultParallelism
    assert run.out().count() == 8


def test_measures_count_each_batch_once(spark, tmp_path):
    from vigilake.operators import expectations as E
    from vigilake.streaming import keyed, measures

    rules = [E.Expectation("positive", "n > 0", E.DROP), E.Expectation("small", "n < 10")]
    turns = [{"t": spark.createDataFrame([(i,) for i in b], "n int")} for b in ([1, 0, 50], [-1, -2], [3])]
    with measures.Measures(spark, str(tmp_path / "m")) as kept:
        assert kept.table().count() == 0
        run = replay.in_turns(spark, {"t": turns[0]["t"].schema}, lambda t: E.apply(t, rules, "rules"), turns, name="counted")
        kept.wait(run.query.runId)
        keyed.forget_commit(spark, run.checkpoint)  # the last batch comes again
        run.start()
        run.query.processAllAvailable()
        run.stop()
        kept.wait(run.query.runId)
    rows = kept.table().filter("query = 'counted' AND measure LIKE 'rules.%' AND batch_id < 3").collect()
    got = {(r.batch_id, r.measure): r.value for r in rows}
    assert len(rows) == len(got) == 9
    assert [[got[b, f"rules.{m}"] for m in ("rows", "positive", "small")] for b in range(3)] == [[3, 1, 1], [2, 2, 0], [1, 0, 0]]
    assert {r.measure for r in kept.table().collect()} >= {"input_rows", "duration_ms", "state_rows", "rows_behind_watermark"}


def test_keyed_table(spark, tmp_path):
    from vigilake.streaming import keyed

    batch = lambda *rows: spark.createDataFrame(list(rows), "k string, n long")
    t = keyed.Keyed(str(tmp_path / "k"), batch(("a", 1)).schema, ["k"])
    t.upsert(batch(("a", 1), (None, 5)), 0)
    t.upsert(batch(("a", 2), ("b", 1)), 1)
    t.upsert(batch(("a", 9)), 1)  # came before
    t.upsert(batch(("c", 7)), 0)
    assert sorted(map(tuple, t.read(spark).collect()), key=str) == [("a", 2), ("b", 1), (None, 5)]
    t.upsert(batch((None, 6)), 4)
    assert sorted(map(tuple, t.read(spark).collect()), key=str) == [("a", 2), ("b", 1), (None, 6)]


def test_hot_card_is_dealt_to_many_tasks(spark):
    """A third of all transactions are of one card: with salts no part of the join has above twice the rows of the median."""
    t = spark.range(12_000).selectExpr("concat('T', id) AS transaction_id", "if(id % 3 = 0, 'hot', concat('c', id)) AS card_number", "current_timestamp() AS transaction_timestamp")
    w = spark.createDataFrame([("W1", "hot", START), ("W2", "hot", START), ("W3", "c1", START), ("W4", "none", START)], "watchlist_id string, entity_id string, effective_from timestamp")
    plain, salted = alerts.card_matches(t, w), alerts.card_matches(t, w, salts=16)
    ids = lambda df: sorted((r.t.transaction_id, r.w.watchlist_id) for r in df.collect())
    assert ids(plain) == ids(salted) and len(ids(plain)) == 8001
    parts = t.withColumn("__salt", F.pmod(F.xxhash64("transaction_id"), F.lit(16)).cast("int")).withColumn("p", F.pmod(F.hash("card_number", "__salt"), F.lit(8)))
    sizes = sorted(r["count"] for r in parts.groupBy("p").count().collect())
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]


def test_deliveries_in_a_batch(spark):
    from vigilake.operators import deliveries

    assert deliveries.once(spark.createDataFrame([(1, at(0)), (1, at(0)), (2, at(1))], "k int, t timestamp"), ["k"], "t", "1 minute").count() == 2


def test_nothing_is_left_in_the_catalog(spark):
    from tests.conftest import SF
    from vigilake.plans import catalog

    before = {t.name for t in spark.catalog.listTables()}
    for name in ("batch_table", "stream_json_watchlist"):
        assert catalog.QUERIES[name](spark, SF).count() > 0
    assert {t.name for t in spark.catalog.listTables()} == before
