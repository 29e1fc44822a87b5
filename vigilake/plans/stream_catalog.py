"""Registered queries of running streams, and the same in SQL. They are part of vigilake.plans.catalog."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vigilake import schemas, storage
from vigilake.operators import alerts, deliveries, refine, windows
from vigilake.plans import catalog as c
from vigilake.plans import medallion, pipeline, reports, views
from vigilake.session import scratch_path
from vigilake.sources import evolving, files
from vigilake.streaming import keyed, measures, replay, state, stateful

# -- the whole flow, running: it starts on empty storage, gets two bursts, and is stopped and started again between them

_BURST = "(SELECT min(ts) + INTERVAL 10 DAY FROM events)"
_KNOWN = f"(t.transaction_timestamp >= {_BURST} OR CAST(substr(c.customer_id, 5) AS BIGINT) % 2 = 0)"
_HIGH_RENEWED = c._HIGH.format(at=c._AT) + f" AND {_KNOWN}"
_FRAUD_RENEWED = c._FRAUD.format(at=c._AT, c="c") + f" AND {_KNOWN}"


def _arrive(spark: SparkSession, root: str, name: str, rows: DataFrame) -> None:
    """Puts rows into an input's folder, all files at once."""
    staged = f"{root}/arriving/{uuid.uuid4().hex}"
    rows.write.parquet(staged)
    storage.move(spark, staged, f"{root}/in/{name}/{uuid.uuid4().hex}")


@c.query(f"WITH {c._SILVER_T}, {c._C}, {c._W} {c._MEDALLION.replace('@high', _HIGH_RENEWED).replace('@fraud', _FRAUD_RENEWED)}")
def medallion_running(spark, sf_dir):
    """Half of the customers are there for the first burst of transactions, all of them for the second: each micro-batch meets those that are there by then."""
    root, given = scratch_path(spark, "running"), c._medallion_inputs(spark, sf_dir)
    storage.create(spark, f"{root}/pipeline.json", json.dumps({"name": "running", "storage": root, "continuous": True, "every": "0 seconds"}))
    settings = pipeline.Settings.load(spark, f"{root}/pipeline.json")
    inputs = {n: (f"{root}/in/{n}", df.schema) for n, df in given.items()}
    even, early = "cast(substring(customer_id, 5) as bigint) % 2 = 0", f"timestamp < timestamp'{given['transaction_messages'].agg(F.min('timestamp')).first()[0]}' + INTERVAL 10 DAY"
    for turn, (customers, messages) in enumerate(((even, early), (f"NOT ({even})", f"NOT ({early})"))):
        line = pipeline.Pipeline(spark, medallion.build(), settings, inputs)
        line.run()
        _arrive(spark, root, "customer_profiles", given["customer_profiles"].filter(customers))
        if turn == 0:
            _arrive(spark, root, "watchlist_files", given["watchlist_files"])
        line.drain()
        _arrive(spark, root, "transaction_messages", given["transaction_messages"].filter(messages))
        line.stop(drain=True)
    return c._medallion_rows({d.name: line.table(d.name) for d in line.registry.order()})


# -- scores in event time: rows of four micro-batches come up to a minute out of order, each customer's state goes when it is quiet

_DISORDER_S, _DELAY = 60, "2 minutes"


def _scored_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions as fraud_score has them, with customer and merchant looked up, and `turn`, in which they come."""
    rows = c._to_score(spark, sf_dir)
    low, high = rows.agg(F.unix_micros(F.min("transaction_timestamp")), F.unix_micros(F.max("transaction_timestamp"))).first()
    jitter = F.pmod(F.xxhash64("transaction_id"), F.lit(_DISORDER_S * 1_000_000))
    return rows.withColumn("turn", F.least(F.lit(3), F.floor((F.unix_micros("transaction_timestamp") + jitter - low) * 4 / (high - low + 1))))


@c.query(
    f"""WITH {c._SCORED} SELECT r.transaction_id, CAST(least(100, {c._SUM}) AS INTEGER) AS fraud_score, {c._FIRST} AS fraud_reason FROM r JOIN s USING (transaction_id)
WHERE u <= ((SELECT max(u) FROM s) // 1000 - 120000) * 1000"""
)
def stream_fraud_score(spark, sf_dir):
    """Equal to fraud_score for all rows that the watermark has passed at the end."""
    rows = _scored_inputs(spark, sf_dir)
    plan = lambda t: stateful.score_stream(t, delay=_DELAY).select("transaction_id", "fraud_score", "fraud_reason")
    with replay.rocksdb(spark):
        return replay.in_turns(spark, {"t": rows.schema}, plan, [{"t": rows.filter(F.col("turn") == k)} for k in range(4)], stops=(2,)).out()


# -- measures, kept by a listener: what each batch says of itself, against counts of the rows that it got


def _measured(spark: SparkSession, schemas, plan, turns) -> DataFrame:
    """turn (from 0), measure, value of the batches that had rows."""
    with measures.Measures(spark, scratch_path(spark, "measures")) as kept:
        run = replay.in_turns(spark, schemas, plan, turns, name=f"measured-{uuid.uuid4().hex}")
        kept.wait(run.query.runId)
    rows = kept.table().filter(F.col("query") == run.query.name)
    batches = rows.filter("measure = 'input_rows' AND value > 0").select("batch_id", F.row_number().over(W.orderBy("batch_id")).alias("turn"))
    return rows.join(batches, "batch_id").select((F.col("turn") - 1).alias("turn"), "measure", F.col("value").cast("long").alias("value"))


_EXPECTED = ["valid_transaction_id", "valid_customer_id", "valid_card_number", "valid_merchant_id", "valid_amount"]


@c.query(
    f"""WITH b AS (SELECT event_id % 3 AS turn, event_id % {views.BROKEN} = 0 AS broken, event_id % {views.NO_CARD} = 0 AS no_card, value FROM events),
g AS (SELECT turn, count(*) AS n, count(*) FILTER (broken) AS lost, count(*) FILTER (broken OR no_card) AS cardless, count(*) FILTER (broken OR NOT value > 0) AS worthless FROM b GROUP BY turn)
SELECT CAST(turn AS INTEGER) AS turn, unnest(['input_rows', 'silver.rows', {', '.join(f"'silver.{e}'" for e in _EXPECTED)}]) AS measure, unnest([n, n, lost, lost, cardless, lost, worthless]) AS value FROM g"""
)
def stream_expectation_counts(spark, sf_dir):
    """Rows that fail each expectation, batch by batch, counted in the pass that drops them."""
    rows = views.messages(spark, sf_dir)
    found = _measured(spark, {"m": rows.schema}, lambda m: refine.silver_transactions(refine.bronze_transactions(m), observe="silver"), [{"m": rows.filter(F.col("offset") % 3 == k)} for k in range(3)])
    return found.filter((F.col("measure") == "input_rows") | F.startswith("measure", F.lit("silver.")))


# -- deliveries that come twice: turns hold a third of the rows each, and all but the first hold those of the turn before again

_TURNS = f"""d AS (SELECT CAST(least(2, (epoch_us(ts) - (SELECT epoch_us(min(ts)) FROM events)) * 3 // (SELECT epoch_us(max(ts)) - epoch_us(min(ts)) + 1 FROM events)) AS INTEGER) AS third, * FROM events),
x AS (SELECT third AS turn, * FROM d UNION ALL SELECT third + 1 AS turn, * FROM d), m AS (SELECT third, epoch_us(max(ts)) // 1000 * 1000 - 300000000 AS mark FROM d GROUP BY third)"""


def _thirds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column]:
    t = views.transactions(spark, sf_dir)
    low, high = t.agg(F.unix_micros(F.min("transaction_timestamp")), F.unix_micros(F.max("transaction_timestamp"))).first()
    return t, F.expr(f"(unix_micros(transaction_timestamp) - {low}) * 3 div {high - low + 1}")


def _twice(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[dict[str, DataFrame]]]:
    t, third = _thirds(spark, sf_dir)
    return t, [{"t": t.filter(third.isin(*[k for k in (turn - 1, turn) if 0 <= k < 3]))} for turn in range(4)]


def _delivered_twice(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[dict[str, str]]]:
    """The same turns, all of them written in one pass."""
    t, third = _thirds(spark, sf_dir)
    return t, [{"t": folder} for folder in replay.staged(t, F.explode(F.array(third, third + 1)), 4)]


@c.query(views.SQL["transactions"])
def stream_deliveries_once(spark, sf_dir):
    t, turns = _delivered_twice(spark, sf_dir)
    return replay.in_turns(spark, {"t": t.schema}, lambda t: deliveries.once(t, ["transaction_id"], "transaction_timestamp", "5 minutes"), turns, stops=(2,)).out()


@c.query(
    f"""WITH {_TURNS} SELECT x.turn, unnest(['input_rows', 'rows_behind_watermark']) AS measure, unnest([count(*), count(*) FILTER (epoch_us(ts) <= m.mark)]) AS value FROM x LEFT JOIN m ON m.third = x.turn - 1 GROUP BY x.turn"""
)
def stream_late_counts(spark, sf_dir):
    """Rows of each batch, and those that came behind the watermark."""
    t, turns = _delivered_twice(spark, sf_dir)
    found = _measured(spark, {"t": t.schema}, lambda t: deliveries.once(t, ["transaction_id"], "transaction_timestamp", "5 minutes"), turns)
    return found.filter(F.col("measure").isin("input_rows", "rows_behind_watermark"))


# -- open state


@c.query(f"SELECT *, window_end > (SELECT max(ts) - INTERVAL 5 MINUTE FROM events) AS is_open FROM ({c._TUMBLING})")
def stream_open_windows(spark, sf_dir):
    """Windows that have been emitted, and those that the stream still holds: all of the batch's, in three micro-batches."""
    t, turns = _twice(spark, sf_dir)
    turns = [{"t": turns[0]["t"]}, {"t": turns[1]["t"].exceptAll(turns[0]["t"])}, {"t": turns[3]["t"]}]
    run = replay.in_turns(spark, {"t": t.schema}, lambda t: windows.per_minute(t, watermark="5 minutes"), turns)
    return run.out().withColumn("is_open", F.lit(False)).unionByName(state.open_windows(spark, run.checkpoint).withColumn("is_open", F.lit(True)))


@c.query(f"WITH {c._T}, {c._W} SELECT 'transaction' AS kind, transaction_id AS id, card_number AS card FROM t UNION ALL SELECT 'listing', watchlist_id, entity_id FROM w")
def stream_waiting_rows(spark, sf_dir):
    """Without a retention the join of transactions and listings holds every row of both, for ever; its state shows it."""
    t, w = views.transactions(spark, sf_dir), c._silver_watchlist(spark, sf_dir)
    run = replay.in_turns(spark, {"t": t.schema, "w": w.schema}, lambda t, w: alerts.card_matches(t, w, watermark="5 minutes").select("t.transaction_id", "w.watchlist_id"), [{"t": t, "w": w}])
    left = state.waiting(spark, run.checkpoint, "left").select(F.lit("transaction").alias("kind"), F.col("transaction_id").alias("id"), F.col("card_number").alias("card"))
    return left.unionByName(state.waiting(spark, run.checkpoint, "right").select(F.lit("listing").alias("kind"), F.col("watchlist_id").alias("id"), F.col("entity_id").alias("card")))


# -- the stream-stream join with bounded state: both sides up to a day out of order, in four micro-batches, cards dealt to eight tasks

_DAY_US = 86_400_000_000


@c.query(c.ORACLE_SQL["fraud_card_alert_bounded"])
def stream_fraud_card_bounded(spark, sf_dir):
    t, w, known = views.transactions(spark, sf_dir), c._silver_watchlist(spark, sf_dir), views.customers(spark, sf_dir)
    low, high = t.agg(F.unix_micros(F.min("transaction_timestamp")), F.unix_micros(F.max("transaction_timestamp"))).first()

    def dealt(rows: DataFrame, time: str, key: str) -> list[str]:
        place = F.floor((F.unix_micros(time) + F.pmod(F.xxhash64(key), F.lit(_DAY_US)) - low) * 4 / (high - low + 1))
        return replay.staged(rows, F.coalesce(F.greatest(F.lit(0), F.least(F.lit(3), place)), F.lit(0)), 4)

    turns = [{"t": a, "w": b} for a, b in zip(dealt(t, "transaction_timestamp", "transaction_id"), dealt(w, "effective_from", "watchlist_id"))]
    plan = lambda t, w: alerts.card_matches(t, w, retention="10 DAY", watermark="2 days", salts=8)
    matches = replay.in_turns(spark, {"t": t.schema, "w": w.schema}, plan, turns, stops=(3,)).out()
    return alerts.as_card_alerts(matches, known, c._now())


# -- dashboards kept up to date: update-mode aggregates, upserted by batch, the last batch twice


def _kept(spark: SparkSession, sf_dir: str, plan, keys: list[str]) -> DataFrame:
    t, turns = _twice(spark, sf_dir)
    turns = [{"t": turns[0]["t"]}, {"t": turns[1]["t"].exceptAll(turns[0]["t"])}, {"t": turns[3]["t"]}]
    board = keyed.Keyed(scratch_path(spark, "board"), plan(t).schema, keys)
    run = replay.in_turns(spark, {"t": t.schema}, plan, turns, mode="update", write=board.upsert)
    keyed.forget_commit(spark, run.checkpoint)
    run.start()
    run.query.processAllAvailable()
    run.stop()
    return board.read(spark)


@c.query(c.ORACLE_SQL["avg_amount_trend"])
def stream_amount_trend(spark, sf_dir):
    return _kept(spark, sf_dir, lambda t: reports.amount_trend(t), ["bucket_start"])


@c.query(f"WITH {c._T}, {c._C} SELECT customer_id, count(*) AS alert_count, max(transaction_timestamp) AS last_alert FROM ({c._HIGH.format(at=c._AT)}) GROUP BY ALL")
def stream_alerts_by_customer(spark, sf_dir):
    known = views.customers(spark, sf_dir)

    def plan(t: DataFrame) -> DataFrame:
        return alerts.high_value_alerts(t, known, c._now()).groupBy("customer_id").agg(F.count(F.lit(1)).alias("alert_count"), F.max("transaction_timestamp").alias("last_alert"))

    return _kept(spark, sf_dir, plan, ["customer_id"])


# -- fields that turn up: inferred from the first batch, rescued in the batch that brings them, columns from the next one on

_LINE = """concat('{"event_id":', CAST(event_id AS @), ',"kind":"', event_type, '"', 
  CASE WHEN event_id % 3 > 0 THEN concat(',"channel":"', CASE WHEN event_id % 2 = 0 THEN 'POS' ELSE 'WEB' END, '","tries":', CAST(event_id % 7 AS @)) ELSE '' END, '}')"""


@c.query(
    """SELECT event_id, event_type AS kind, CASE WHEN event_id % 3 = 2 THEN CASE WHEN event_id % 2 = 0 THEN 'POS' ELSE 'WEB' END END AS channel, CASE WHEN event_id % 3 = 2 THEN event_id % 7 END AS tries,
  CASE WHEN event_id % 3 = 1 THEN '{"channel":"' || CASE WHEN event_id % 2 = 0 THEN 'POS' ELSE 'WEB' END || '","tries":"' || (event_id % 7) || '"}' END AS _rescued_data FROM events"""
)
def stream_schema_evolves(spark, sf_dir):
    root = scratch_path(spark, "evolving")
    lines = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("event_id", f"{_LINE.replace('@', 'STRING')} AS value")
    table = evolving.EvolvingTable(spark, f"{root}/in", root)
    for k in range(3):
        lines.filter(F.col("event_id") % 3 == k).select("value").write.text(f"{root}/arriving/{k}")
        storage.move(spark, f"{root}/arriving/{k}", f"{root}/in/{k}")
        table.take()
    return table.read().select("event_id", "kind", "channel", "tries", "_rescued_data")


@c.query(c.ORACLE_SQL["rescued_fields"])
def stream_rescued_fields(spark, sf_dir):
    """rescued_fields, line by line of a stream, in three micro-batches."""
    lines = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("event_id", f"{c._RESCUE.replace('@', 'STRING')} AS value")
    plan = lambda m: files.rescued(m, schemas._struct("transaction_id:s amount:d")).select("event_id", "transaction_id", "amount", "_rescued_data")
    return replay.in_turns(spark, {"m": lines.schema}, plan, [{"m": lines.filter(F.col("event_id") % 3 == k)} for k in range(3)]).out()
