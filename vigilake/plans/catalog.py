"""Registered queries of the fraud engine, and the same in SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake import schemas
from vigilake.config import SimulatorSettings
from vigilake.functions import render, text, times
from vigilake.operators import alerts, refine, scoring, watchlist, windows
from vigilake.operators import expectations as E
from vigilake.plans import medallion, pipeline, registry, reports, simulate, simulate_sql, views
from vigilake.session import scratch_path
from vigilake.sources import files
from vigilake.streaming import outbox, replay, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Registers the decorated function under its name, with its SQL."""

    def register(f: Callable[[SparkSession, str], DataFrame]):
        key = name or f.__name__
        QUERIES[key] = f
        if sql is not None:
            ORACLE_SQL[key] = sql
        return f

    return register


AS_OF, DASHBOARD = "2024-02-01 00:00:00", "2024-01-30 12:00:00"


def _now():
    return F.lit(AS_OF).cast("timestamp")


def _then():
    return F.lit(DASHBOARD).cast("timestamp")


_T = f"t AS ({views.SQL['transactions']})"
_C = f"c AS ({views.SQL['customers']})"
_W = f"""w AS (SELECT upper(watchlist_id) AS watchlist_id, watch_type, upper(entity_id) AS entity_id, upper(risk_level) AS risk_level, upper(action) AS action,
  reason_code, reason_description, status, try_strptime(effective_from, '%d-%b-%Y %H:%M:%S') AS effective_from, reported_by, reported_source, country, city FROM ({views.SQL['watchlist']}))"""

_HIGH = """SELECT 'ALERT-' || t.transaction_id AS alert_id, 'HIGH_VALUE_TRANSACTION' AS alert_type, {at} AS alert_timestamp, t.transaction_id, t.customer_id,
  c.email AS customer_email, concat_ws(' ', c.first_name, c.last_name) AS customer_name, t.amount AS transaction_amount, c.transaction_limit,
  t.currency, t.merchant_name, t.merchant_category, t.transaction_type, t.payment_channel, t.city, t.country, t.is_international, t.transaction_timestamp, t.status
FROM t JOIN c ON t.customer_id = c.customer_id WHERE t.amount > c.transaction_limit"""
_FRAUD = """SELECT concat_ws('-', 'FRAUD', t.transaction_id, w.watchlist_id) AS alert_id, 'FRAUD_CARD_TRANSACTION' AS alert_type, {at} AS alert_timestamp,
  t.transaction_id, t.customer_id, c.email AS customer_email, concat_ws(' ', c.first_name, c.last_name) AS customer_name, t.card_number, t.amount, t.currency,
  t.merchant_id, t.merchant_name, t.merchant_category, t.transaction_type, t.payment_channel, t.device_id, t.city AS transaction_city, t.country AS transaction_country,
  t.transaction_timestamp, t.is_international, t.status AS transaction_status, w.watchlist_id, w.watch_type, w.risk_level, w.action, w.reason_code, w.reason_description,
  w.effective_from AS watchlist_effective_from, w.reported_by, w.reported_source, w.city AS watchlist_city, w.country AS watchlist_country
FROM t JOIN w ON t.card_number = w.entity_id LEFT JOIN {c} c ON t.customer_id = c.customer_id"""
_AT = f"TIMESTAMP '{AS_OF}'"
_OWN = "t.transaction_timestamp"


def _silver_watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = views.watchlist(spark, sf_dir).withColumn("source_file", F.lit("watchlist"))
    return refine.silver_watchlist(refine.bronze_watchlist(raw, _now()), _now())


def _high(spark: SparkSession, sf_dir: str, at=None) -> DataFrame:
    return alerts.high_value_alerts(views.transactions(spark, sf_dir), views.customers(spark, sf_dir), _now() if at is None else at)


def _fraud(spark: SparkSession, sf_dir: str, at=None, known=None) -> DataFrame:
    customers = views.customers(spark, sf_dir)
    return alerts.fraud_card_alerts(views.transactions(spark, sf_dir), _silver_watchlist(spark, sf_dir), customers if known is None else customers.filter(known), _now() if at is None else at)


# -- alerts


@query(f"WITH {_T}, {_C} {_HIGH.format(at=_AT)}")
def high_value_alert(spark, sf_dir):
    return _high(spark, sf_dir)


@query(f"WITH {_T}, {_C}, {_W} {_FRAUD.format(at=_AT, c='c')}")
def fraud_card_alert(spark, sf_dir):
    return _fraud(spark, sf_dir)


@query(f"WITH {_T}, {_C}, {_W}, half AS (SELECT * FROM c WHERE risk_score < 50) {_FRAUD.format(at=_AT, c='half')}")
def fraud_card_alert_unmatched_customer(spark, sf_dir):
    return _fraud(spark, sf_dir, known="risk_score < 50")


@query(f"WITH {_T}, {_C}, {_W} SELECT * FROM ({_FRAUD.format(at=_AT, c='c')}) WHERE transaction_timestamp >= watchlist_effective_from AND transaction_timestamp <= watchlist_effective_from + INTERVAL 10 DAY")
def fraud_card_alert_bounded(spark, sf_dir):
    return alerts.fraud_card_alerts(views.transactions(spark, sf_dir), _silver_watchlist(spark, sf_dir), views.customers(spark, sf_dir), _now(), retention="10 DAY")


# -- windows

_TUMBLING = f"WITH {_T} SELECT date_trunc('minute', transaction_timestamp) AS window_start, date_trunc('minute', transaction_timestamp) + INTERVAL 1 MINUTE AS window_end, count(*) AS transaction_count FROM t WHERE transaction_timestamp IS NOT NULL GROUP BY ALL"
_SLIDING = f"WITH {_T}, s AS (SELECT date_trunc('minute', transaction_timestamp) - to_minutes(k) AS window_start FROM t, (SELECT unnest(range(5)) AS k) WHERE transaction_timestamp IS NOT NULL) SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, count(*) AS transaction_count FROM s GROUP BY ALL"
_CLOSED = "SELECT * FROM ({}) WHERE window_end <= (SELECT max(ts) - INTERVAL 5 MINUTE FROM events)"


@query(_TUMBLING)
def tx_count_tumbling_1m(spark, sf_dir):
    return windows.per_minute(views.transactions(spark, sf_dir))


@query(_SLIDING)
def tx_count_sliding_5m_1m(spark, sf_dir):
    return windows.five_minutes_sliding(views.transactions(spark, sf_dir))


@query(f"{_SLIDING} ORDER BY window_start DESC LIMIT 10")
def latest_10_windows(spark, sf_dir):
    return windows.latest(tx_count_sliding_5m_1m(spark, sf_dir), 10)


# -- dashboards


@query(f"WITH {_T}, {_C} SELECT * FROM ({_HIGH.format(at=_OWN)}) WHERE alert_timestamp >= TIMESTAMP '{DASHBOARD}' - INTERVAL 1 HOUR ORDER BY alert_timestamp DESC")
def recent_alerts_ordered(spark, sf_dir):
    return reports.newest_first(reports.recent(_high(spark, sf_dir, F.col(_OWN)), _then()))


@query(f"WITH {_T}, {_C}, {_W} SELECT alert_type, risk_level, count(*) AS alert_count, avg(amount) AS avg_amount FROM ({_FRAUD.format(at=_OWN, c='c')}) WHERE alert_timestamp >= TIMESTAMP '{DASHBOARD}' - INTERVAL 1 HOUR GROUP BY ALL")
def alert_summary_by_risk(spark, sf_dir):
    return reports.summary_by_risk(_fraud(spark, sf_dir, F.col(_OWN)), _then())


_BOTH = f"SELECT alert_type, alert_timestamp FROM ({_HIGH.format(at=_OWN)}) UNION ALL SELECT alert_type, alert_timestamp FROM ({_FRAUD.format(at=_OWN, c='c')})"


@query(f"WITH {_T}, {_C}, {_W} SELECT alert_type, count(*) AS alert_count FROM ({_BOTH}) GROUP BY ALL")
def alert_type_distribution(spark, sf_dir):
    return reports.type_distribution([_high(spark, sf_dir), _fraud(spark, sf_dir)])


@query(f"WITH {_T}, {_C}, {_W} SELECT count(*) AS alerts_last_hour FROM ({_BOTH}) WHERE alert_timestamp >= TIMESTAMP '{DASHBOARD}' - INTERVAL 1 HOUR")
def alerts_last_hour(spark, sf_dir):
    return reports.alerts_last_hour([_high(spark, sf_dir, F.col(_OWN)), _fraud(spark, sf_dir, F.col(_OWN))], _then())


@query(f"WITH {_T} SELECT date_trunc('hour', transaction_timestamp) AS bucket_start, avg(amount) AS avg_amount, count(*) AS transaction_count FROM t GROUP BY ALL")
def avg_amount_trend(spark, sf_dir):
    return reports.amount_trend(views.transactions(spark, sf_dir))


@query(f"WITH {_C} SELECT count(*) AS high_risk_customers FROM c WHERE risk_score >= 70")
def high_risk_customers(spark, sf_dir):
    return reports.high_risk_customers(views.customers(spark, sf_dir))


@query("SELECT count(*) AS row_count FROM events")
def bronze_count(spark, sf_dir):
    return reports.count_rows(refine.bronze_transactions(views.messages(spark, sf_dir)))


@query("SELECT count(*) AS row_count FROM events")
def sql_count(spark, sf_dir):
    return spark.sql("SELECT count(*) AS row_count FROM {t}", t=views.transactions(spark, sf_dir))


# -- refined tables

_ENVELOPE = f"SELECT CAST(event_id AS BIGINT) AS kafka_offset, event_id FROM events WHERE event_id % {views.BROKEN} <> 0 AND event_id % {views.NO_CARD} <> 0"
_SILVER = "SELECT t.*, 'transactions' AS kafka_topic, CAST(0 AS INTEGER) AS kafka_partition, CAST(substr(transaction_id, 4) AS BIGINT) AS kafka_offset, transaction_timestamp AS kafka_timestamp, {at} AS bronze_ingestion_timestamp, {at} AS silver_ingestion_timestamp FROM t".format(at=_AT)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refine.silver_transactions(refine.bronze_transactions(views.messages(spark, sf_dir), _now()), _now())


@query(f"WITH {_T} SELECT * REPLACE (date_trunc('millisecond', transaction_timestamp) AS transaction_timestamp) FROM ({_SILVER}) WHERE kafka_offset % {views.BROKEN} <> 0 AND kafka_offset % {views.NO_CARD} <> 0")
def silver_transactions(spark, sf_dir):
    return _silver(spark, sf_dir)


@query(
    f"""WITH b AS (SELECT event_id % {views.BROKEN} = 0 AS broken, event_id % {views.NO_CARD} = 0 AS no_card, value FROM events)
SELECT unnest(['valid_transaction_id', 'valid_customer_id', 'valid_card_number', 'valid_merchant_id', 'valid_amount']) AS expectation,
  unnest([count(*) FILTER (broken), count(*) FILTER (broken), count(*) FILTER (broken OR no_card), count(*) FILTER (broken), count(*) FILTER (broken OR NOT value > 0)]) AS violations FROM b"""
)
def expectation_counts(spark, sf_dir):
    rows = refine.bronze_transactions(views.messages(spark, sf_dir), _now()).select(F.from_json("value", schemas.TRANSACTION).alias("d")).select("d.*")
    return E.violation_counts(rows, refine.TRANSACTION_EXPECTATIONS)


@query(f"WITH {_W} SELECT *, 'watchlist' AS source_file, {_AT} AS bronze_ingestion_timestamp, {_AT} AS silver_ingestion_timestamp FROM w")
def silver_watchlist(spark, sf_dir):
    return _silver_watchlist(spark, sf_dir)


@query(f"WITH {_C} SELECT * REPLACE (CAST(try_strptime(account_open_date, '%Y-%m-%d') AS DATE) AS account_open_date), {_AT} AS silver_ingestion_timestamp FROM c WHERE customer_id IS NOT NULL")
def silver_customers(spark, sf_dir):
    return refine.silver_customers(views.customers(spark, sf_dir), _now())


@query(f"WITH x AS (SELECT *, CAST(substr(upper(watchlist_id), 3) AS BIGINT) AS n FROM ({views.SQL['watchlist']})) SELECT upper(watchlist_id) AS watchlist_id, entity_id FROM x WHERE n > (SELECT coalesce(max(n), 0) FROM x WHERE risk_level = 'high' AND n < 700)")
def watchlist_resume(spark, sf_dir):
    rows = views.watchlist(spark, sf_dir).withColumn("watchlist_id", F.upper("watchlist_id"))
    sent = rows.filter((F.col("risk_level") == "high") & (F.right("watchlist_id", F.lit(6)).cast("long") < 700))
    return watchlist.still_to_send(rows, sent).select("watchlist_id", "entity_id")


# -- functions


@query(
    f"""WITH {_T}, {_C} SELECT t.transaction_id, CASE WHEN coalesce(c.card_number, '') = '' THEN '****' ELSE right(c.card_number, 4) END AS card, coalesce(nullif(c.first_name, ''), 'N/A') AS first_name,
  format('{{:,.2f}}', t.amount * 1000) AS amount, CASE WHEN t.is_international THEN 'Yes' ELSE 'No' END AS international FROM t LEFT JOIN c ON t.customer_id = c.customer_id AND c.risk_score < 50"""
)
def mask_and_format(spark, sf_dir):
    t, c = views.transactions(spark, sf_dir).alias("t"), views.customers(spark, sf_dir).filter("risk_score < 50").alias("c")
    both = t.join(c, F.col("t.customer_id") == F.col("c.customer_id"), "left")
    return both.select("t.transaction_id", text.mask_card(F.col("c.card_number")).alias("card"), text.or_default(F.col("c.first_name")).alias("first_name"), text.money(F.col("t.amount") * 1000).alias("amount"), text.yes_no(F.col("t.is_international")).alias("international"))


@query(
    """SELECT event_id, printf('TXN%07d', event_id) AS transaction_id, printf('DEV%04d', event_id * 7) AS device_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') AS iso,
  date_trunc('second', ts) AS parsed, abs(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-15')) / 60000000.0 AS minutes, greatest(5.0, least(value, 100.0)) AS clamped FROM events"""
)
def ids_and_iso_time(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    iso = times.iso_seconds(F.col("ts"))
    return e.select("event_id", text.numbered("TXN", F.col("event_id"), 7).alias("transaction_id"), text.numbered("DEV", F.col("event_id") * 7, 4).alias("device_id"), iso.alias("iso"), times.parse_iso(iso).alias("parsed"), times.minutes_between(F.col("ts"), F.lit("2024-01-15").cast("timestamp")).alias("minutes"), text.clamp(F.col("value"), F.lit(5.0), F.lit(100.0)).alias("clamped"))


@query(
    """WITH d AS (SELECT o_orderkey, printf('4%015d', o_orderkey * 7919 + o_custkey) AS card FROM orders),
s AS (SELECT o_orderkey, card, sum(CASE WHEN (16 - i) % 2 = 1 THEN (2 * v) // 10 + (2 * v) % 10 ELSE v END) AS total FROM (SELECT o_orderkey, card, i, CAST(substr(card, CAST(i AS INTEGER), 1) AS INTEGER) AS v FROM d, (SELECT unnest(range(1, 17)) AS i)) GROUP BY ALL)
SELECT o_orderkey, card, total % 10 = 0 AS valid FROM s"""
)
def luhn_check(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", text.numbered("4", F.col("o_orderkey") * 7919 + F.col("o_custkey"), 15).alias("card"))
    return o.withColumn("valid", text.is_luhn(F.col("card")))


@query("SELECT o_orderkey, CASE WHEN u < 0.6 THEN 'Regular' WHEN u < 0.8 THEN 'Gold' WHEN u < 0.9 THEN 'Platinum' ELSE 'Corporate' END AS segment FROM (SELECT o_orderkey, (o_orderkey % 1000) / 1000.0 AS u FROM orders)")
def weighted_segments(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    u = (F.col("o_orderkey") % 1000) / 1000.0
    return o.select("o_orderkey", text.weighted_choice(u, [("Regular", 6), ("Gold", 2), ("Platinum", 1), ("Corporate", 1)]).alias("segment"))


# -- scoring: event time is compressed, so that the rules on seconds have something to find

_COMPRESS = 3600
_SCORED = f"""s AS (SELECT t.* EXCLUDE (amount), t.amount * CASE WHEN seq % 50 = 0 THEN 1000 ELSE 1 END AS amount, u, c.trusted_device_id, m.merchant_risk, m.is_blacklisted FROM
  (SELECT *, CAST(substr(transaction_id, 4) AS BIGINT) AS seq, epoch_us(transaction_timestamp) // {_COMPRESS} AS u FROM ({views.SQL['transactions']})) t
  LEFT JOIN ({views.SQL['customers']}) c ON t.customer_id = c.customer_id LEFT JOIN ({views.SQL['merchants']}) m ON t.merchant_id = m.merchant_id),
r AS (SELECT transaction_id, seq,
  coalesce(amount > 100000, false) AS high_value_transaction,
  coalesce(lag(city) OVER w = 'Delhi' AND city = 'London' AND u - lag(u) OVER w <= 1200000000, false) AS impossible_travel,
  device_id IS DISTINCT FROM trusted_device_id AS new_device,
  coalesce(merchant_risk = 'HIGH', false) AS high_risk_merchant,
  coalesce(is_blacklisted, false) AS blacklisted_merchant,
  coalesce(is_international, false) AS international_transaction,
  coalesce(lag(u, 5) OVER w >= u - 30000000, false) AS velocity_fraud,
  coalesce(amount BETWEEN 5 AND 20 AND lag(u, 3) OVER w >= u - 60000000, false) AS card_testing
  FROM s WINDOW w AS (PARTITION BY customer_id ORDER BY u, seq))"""
_RULES = [r.lower() for r in scoring.WEIGHTS]


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = views.transactions(spark, sf_dir).withColumn("seq", F.substring("transaction_id", 4, 19).cast("long"))
    return t.withColumn("transaction_timestamp", F.timestamp_micros(F.expr(f"unix_micros(transaction_timestamp) div {_COMPRESS}"))).withColumn("amount", F.col("amount") * F.when(F.col("seq") % 50 == 0, 1000).otherwise(1))


def _looked_up(t: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    c = views.customers(spark, sf_dir).select("customer_id", "trusted_device_id")
    m = views.merchants(spark, sf_dir).select("merchant_id", "merchant_risk", "is_blacklisted")
    return t.join(c, "customer_id", "left").join(m, "merchant_id", "left")


def _to_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _looked_up(_timed(spark, sf_dir), spark, sf_dir)


def _flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.row_flags(_looked_up(scoring.look_back_flags(_timed(spark, sf_dir)), spark, sf_dir))


for _rule in _RULES:

    @query(f"WITH {_SCORED} SELECT transaction_id FROM r WHERE {_rule}", name=f"rule_{_rule}")
    def _(spark, sf_dir, rule=_rule):
        return _flags(spark, sf_dir).filter(rule).select("transaction_id")


_SUM = " + ".join(f"CASE WHEN {r} THEN {w} ELSE 0 END" for r, w in zip(_RULES, scoring.WEIGHTS.values()))
_FIRST = "CASE " + " ".join(f"WHEN {r} THEN '{r.upper()}'" for r in _RULES) + " ELSE 'NORMAL' END"
_HEAVIEST = "CASE " + " ".join(f"WHEN {r.lower()} THEN '{r}'" for r, _ in sorted(scoring.WEIGHTS.items(), key=lambda x: -x[1])) + " END"


@query(f"WITH {_SCORED} SELECT transaction_id, CAST(least(100, {_SUM}) AS INTEGER) AS fraud_score, {_FIRST} AS fraud_reason FROM r")
def fraud_score(spark, sf_dir):
    return scoring.fraud_scores(_flags(spark, sf_dir)).select("transaction_id", "fraud_score", "fraud_reason")


@query(f"WITH {_SCORED} SELECT transaction_id, {_HEAVIEST} AS fraud_reason FROM r WHERE {_HEAVIEST} IS NOT NULL")
def forced_reason(spark, sf_dir):
    scored = scoring.fraud_scores(_flags(spark, sf_dir).filter(" OR ".join(_RULES)), forced=F.lit(True))
    return scored.select("transaction_id", "fraud_reason")


_CHOSEN = simulate_sql.pick(simulate_sql.uniform(42, "rule", "transaction_id"), list(scoring.WEIGHTS))
_CHOSEN_WEIGHT = f"CASE {_CHOSEN} " + " ".join(f"WHEN '{r}' THEN {w}" for r, w in scoring.WEIGHTS.items()) + " END"


@query(f"WITH {_SCORED} SELECT transaction_id, CAST(least(100, CASE WHEN {_SUM} = 0 THEN {_CHOSEN_WEIGHT} ELSE {_SUM} END) AS INTEGER) AS fraud_score, coalesce({_HEAVIEST}, {_CHOSEN}) AS fraud_reason FROM r")
def forced_score(spark, sf_dir):
    """Every row forced: rows that trigger nothing get a rule chosen by seed and id."""
    return scoring.fraud_scores(_flags(spark, sf_dir), forced=F.lit(True)).select("transaction_id", "fraud_score", "fraud_reason")


@query(f"WITH {_SCORED}, x AS (SELECT r.transaction_id, {_SUM} AS score, u FROM r JOIN s USING (transaction_id)) SELECT count(*) AS produced, 100.0 * avg(CASE WHEN score > 0 THEN 1.0 ELSE 0.0 END) AS fraud_percentage, (max(u) - min(u)) / 1e6 AS runtime_seconds, count(*) / ((max(u) - min(u)) / 1e6) AS average_tps FROM x")
def production_stats(spark, sf_dir):
    return reports.production_stats(scoring.fraud_scores(_flags(spark, sf_dir)))


# -- the simulator: a transaction for each event

_NUMBERS = "SELECT event_id AS seq FROM events"
_SIM = simulate_sql.transactions(_NUMBERS)
_FEED = f"SELECT * REPLACE ({simulate_sql.normal_amount()} AS amount) FROM ({_SIM})"
_LISTED_CARD = "4999999999999996"


def _simulated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simulate.transactions(spark, spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("seq")))


@query(simulate_sql.customers())
def sim_customers(spark, sf_dir):
    return simulate.customers(spark)


@query(simulate_sql.merchants())
def sim_merchants(spark, sf_dir):
    return simulate.merchants(spark)


@query(_SIM)
def sim_transactions(spark, sf_dir):
    return _simulated(spark, sf_dir)


@query(f"WITH s AS ({_SIM}), c AS ({simulate_sql.customers()}) SELECT customer_segment, merchant_category, count(*) AS transaction_count FROM s JOIN c USING (customer_id) GROUP BY ALL")
def sim_categories_by_segment(spark, sf_dir):
    people = simulate.customers(spark).select("customer_id", "customer_segment")
    return _simulated(spark, sf_dir).join(people, "customer_id").groupBy("customer_segment", "merchant_category").agg(F.count(F.lit(1)).alias("transaction_count"))


@query(_FEED)
def feed_normal(spark, sf_dir):
    return simulate.normal_feed(_simulated(spark, sf_dir))


@query(f"SELECT * REPLACE ('TXF' || substr(transaction_id, 4) AS transaction_id, greatest(amount, 100001.0::DOUBLE) AS amount) FROM ({_SIM})")
def feed_high_value(spark, sf_dir):
    return simulate.high_value_feed(_simulated(spark, sf_dir))


@query(f"SELECT * REPLACE ('TXF' || substr(transaction_id, 4) AS transaction_id, '{_LISTED_CARD}' AS card_number) FROM ({_FEED})")
def feed_listed_card(spark, sf_dir):
    return simulate.listed_card_feed(_simulated(spark, sf_dir), _LISTED_CARD)


@query(f"SELECT transaction_id AS key, customer_id, amount, is_international, date_trunc('second', transaction_timestamp) AS transaction_timestamp, 16 AS fields FROM ({_FEED})")
def feed_messages(spark, sf_dir):
    """The normal feed as messages, parsed again."""
    sent = simulate.as_messages(simulate.normal_feed(_simulated(spark, sf_dir)))
    read = sent.select("key", F.from_json("value", schemas.TRANSACTION).alias("d"), F.size(F.json_object_keys("value")).alias("fields"))
    return read.select("key", "d.customer_id", "d.amount", "d.is_international", "d.transaction_timestamp", "fields")


@query(f"SELECT seq, {simulate_sql.uniform(42, 'forced', 'seq')} < 0.08::DOUBLE AS forced FROM ({_NUMBERS})")
def forced_draw(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("seq")).withColumn("forced", simulate.forced(SimulatorSettings()))


@query("SELECT event_id, floor(value * 100 + 0.5::DOUBLE) / 100::DOUBLE AS rounded FROM events")
def rounded_amounts(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", text.cents(F.col("value")).alias("rounded"))


# -- files: written to the scratch folder, then read


@query(f"SELECT printf('TXN%07d', event_id) AS key, event_id % {views.BROKEN} <> 0 AS valid FROM events")
def json_validate(spark, sf_dir):
    return refine.bronze_transactions(views.messages(spark, sf_dir), _now()).select("key", text.is_json(F.col("value")).alias("valid"))


@query("SELECT n_nationkey, '{\"n_comment_length\":' || length(n_name) || ',\"n_name\":\"' || n_name || '\",\"n_regionkey\":' || n_regionkey || '}' AS json FROM nation")
def json_sorted(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").withColumn("n_comment_length", F.length("n_name"))
    return n.select("n_nationkey", text.sorted_json(["n_regionkey", "n_name", "n_comment_length"]).alias("json"))


_RESCUE = """CASE WHEN event_id % 11 = 0 THEN '{"transaction_id":' ELSE '{"transaction_id":"T' || event_id || '","amount":' || CASE WHEN event_id % 7 = 0 THEN '"abc"' ELSE CAST(event_id AS @) END || CASE WHEN event_id % 5 = 0 THEN ',"extra":"x' || event_id || '"' ELSE '' END || '}' END"""


@query(
    """SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN 'T' || event_id END AS transaction_id, CASE WHEN event_id % 11 <> 0 AND event_id % 7 <> 0 THEN CAST(event_id AS DOUBLE) END AS amount,
  CASE WHEN event_id % 11 = 0 THEN '{"_corrupt_record":"{\\"transaction_id\\":"}' WHEN event_id % 35 = 0 THEN '{"extra":"x' || event_id || '","amount":"abc"}'
    WHEN event_id % 5 = 0 THEN '{"extra":"x' || event_id || '"}' WHEN event_id % 7 = 0 THEN '{"amount":"abc"}' END AS _rescued_data FROM events"""
)
def rescued_fields(spark, sf_dir):
    """Lines with unknown fields, values of another type, and broken ones."""
    lines = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("event_id", f"{_RESCUE.replace('@', 'STRING')} AS value")
    return files.rescued(lines, schemas._struct("transaction_id:s amount:d")).select("event_id", "transaction_id", "amount", "_rescued_data")


@query(views.SQL["customers"])
def csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "customers_csv")
    simulate.write_csv(views.customers(spark, sf_dir), path)
    return files.csv_table(spark, path, schemas.CUSTOMER)


_DRIP = f"SELECT *, 'fraud_watchlist_20240201000000_' || row_number() OVER (ORDER BY watchlist_id) || '.json' AS file FROM ({views.SQL['watchlist']})"


def _dripped(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "drip")
    watchlist.drip(views.watchlist(spark, sf_dir), path, seconds=0, stamp="20240201000000")
    return path


@query(f"SELECT watchlist_id, entity_id, city, file FROM ({_DRIP})")
def drip_lineage(spark, sf_dir):
    """One file a row; each row names its file."""
    rows = refine.bronze_watchlist(spark.read.schema(schemas.WATCHLIST).json(_dripped(spark, sf_dir)), _now())
    return rows.select("watchlist_id", "entity_id", "city", F.element_at(F.split("source_file", "/"), -1).alias("file"))


@query(f"""SELECT file, CASE WHEN ends_with(file, '_1.json') THEN '{{"watchlist_id":"' || watchlist_id END AS head FROM ({_DRIP})""")
def listing_and_head(spark, sf_dir):
    path = _dripped(spark, sf_dir)
    found = files.listing(spark, path, "*.json").select(F.element_at(F.split("path", "/"), -1).alias("file"))
    first = files.head(spark, f"{path}/fraud_watchlist_20240201000000_1.json", 25)
    return found.withColumn("head", F.when(F.endswith("file", F.lit("_1.json")), F.lit(first)))


@query(f"WITH {_W} SELECT * FROM w")
def stream_json_watchlist(spark, sf_dir):
    """The dripped files as a stream, each once, refined into a table."""
    found = files.json_stream(spark, _dripped(spark, sf_dir), schemas.WATCHLIST, files_per_trigger=500)
    rows = refine.silver_watchlist(refine.bronze_watchlist(found, _now()), _now())
    return replay.to_table(spark, rows, f"watchlist_{uuid.uuid4().hex}").drop("source_file", "bronze_ingestion_timestamp", "silver_ingestion_timestamp")


@query(f"WITH {_C} SELECT customer_id, card_number FROM c WHERE customer_id IS NOT NULL")
def batch_table(spark, sf_dir):
    name = f"customers_{uuid.uuid4().hex}"
    path = scratch_path(spark, name)
    saved = registry.save_table(refine.silver_customers(views.customers(spark, sf_dir), _now()).select("customer_id", "card_number"), name, path)
    spark.sql(f"DROP TABLE {name}")  # its files stay, at a path of its own
    return spark.read.schema(saved.schema).parquet(path)


# -- mail


def _html(value: str) -> str:
    out = f"coalesce(CAST({value} AS VARCHAR), '')"
    for plain, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&#39;")):
        out = f"replace({out}, '{plain}', '{safe}')"
    return out


_MONEY = "format('{{:,.2f}}', {})".format
_PLACE = "concat_ws(', ', coalesce(nullif(watchlist_city, ''), 'N/A'), coalesce(nullif(watchlist_country, ''), 'N/A'))"
_MAIL = [
    ("Alert", "alert_id"), ("Type", "alert_type"), ("Raised", "alert_timestamp"), ("Customer", "customer_name"), ("Transaction", "transaction_id"), ("Card", "'****' || right(card_number, 4)"),
    ("Amount", f"{_MONEY('amount')} || ' ' || currency"), ("Merchant", "merchant_name"), ("Category", "merchant_category"), ("Kind", "transaction_type"), ("Channel", "payment_channel"),
    ("Place", "concat_ws(', ', transaction_city, transaction_country)"), ("International", "CASE WHEN is_international THEN 'Yes' ELSE 'No' END"), ("Time", "transaction_timestamp"), ("Status", "transaction_status"),
    ("Listing", "watchlist_id"), ("Listed as", "watch_type"), ("Risk", "risk_level"), ("Action", "action"), ("Reason", "reason_description"), ("Reported by", "reported_by"), ("Source", "reported_source"),
    ("Listed place", _PLACE), ("Effective from", "watchlist_effective_from"),
]
_BODY = " || ".join(f"'<tr><th>{name}</th><td>' || {_html(value)} || '</td></tr>'" for name, value in _MAIL)


@query(f"WITH {_T}, {_C}, {_W} SELECT alert_id, customer_email AS mail_to, 'Card alert: ' || coalesce(risk_level, 'unknown') || ' risk, ' || alert_id AS mail_subject, '<table>' || {_BODY} || '</table>' AS mail_body FROM ({_FRAUD.format(at=_AT, c='c')})")
def fraud_mails(spark, sf_dir):
    return render.fraud_mail(_fraud(spark, sf_dir)).select("alert_id", "mail_to", "mail_subject", "mail_body")


_ROW = [
    "alert_id", "customer_name", "customer_email", f"concat_ws(' ', currency, {_MONEY('transaction_amount')})", f"concat_ws(' ', currency, {_MONEY('transaction_limit')})", "merchant_name", "concat_ws(', ', city, country)", "transaction_timestamp",
]
_DIGEST = " || ".join(f"'<td>' || {_html(v)} || '</td>'" for v in _ROW)


@query(f"WITH {_T}, {_C} SELECT alert_id, '<tr>' || {_DIGEST} || '</tr>' AS digest_row FROM ({_HIGH.format(at=_AT)})")
def digest_rows(spark, sf_dir):
    return _high(spark, sf_dir).select("alert_id", render.digest_row().alias("digest_row"))


# -- streams: drained once, then read back; windows that are still open have no row


@query(_CLOSED.format(_TUMBLING))
def stream_tumbling(spark, sf_dir):
    return replay.drain(spark, {"t": views.transactions(spark, sf_dir)}, lambda t: windows.per_minute(t, watermark="5 minutes"))


@query(_CLOSED.format(_SLIDING))
def stream_sliding(spark, sf_dir):
    return replay.drain(spark, {"t": views.transactions(spark, sf_dir)}, lambda t: windows.five_minutes_sliding(t, watermark="5 minutes"))


@query(f"WITH {_T}, {_C} {_HIGH.format(at=_AT)}")
def stream_high_value(spark, sf_dir):
    customers = views.customers(spark, sf_dir)
    return replay.drain(spark, {"t": views.transactions(spark, sf_dir)}, lambda t: alerts.high_value_alerts(t, customers, _now()))


@query(f"WITH {_T}, {_C}, {_W} {_FRAUD.format(at=_AT, c='c')}")
def stream_fraud_card(spark, sf_dir):
    customers = views.customers(spark, sf_dir)
    return replay.drain(spark, {"t": views.transactions(spark, sf_dir), "w": _silver_watchlist(spark, sf_dir)}, lambda t, w: alerts.fraud_card_alerts(t, w, customers, _now(), watermark="5 minutes"))


# -- streams in several micro-batches: three in order of time, then rows that come when their windows are long closed

_LATE = "event_id % 50 = 0 AND ts < (SELECT min(ts) + INTERVAL 1 DAY FROM events)"
_PUNCTUAL = "SELECT * FROM ({}) WHERE window_end <= (SELECT max(ts) - INTERVAL 5 MINUTE FROM on_time)"


def _late_sql(windows_sql: str) -> str:
    """The windows of events that are not late."""
    return f"WITH on_time AS (SELECT * FROM events WHERE NOT ({_LATE})) " + _PUNCTUAL.format(windows_sql.replace("FROM events", "FROM on_time"))


def _slices(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    t = views.transactions(spark, sf_dir)
    low, high = t.agg(F.min("transaction_timestamp"), F.max("transaction_timestamp")).first()
    cut = [low + (high - low) * k / 3 for k in (1, 2)]
    at = "transaction_timestamp"
    late = f"(cast(substring(transaction_id, 4) as bigint) % 50 = 0 AND {at} < timestamp'{low}' + INTERVAL 1 DAY)"
    spans = [f"{at} < timestamp'{cut[0]}'", f"{at} >= timestamp'{cut[0]}' AND {at} < timestamp'{cut[1]}'", f"{at} >= timestamp'{cut[1]}'"]
    return t, [f"{s} AND NOT {late}" for s in spans] + [late]


@query(_late_sql(_TUMBLING))
def stream_tumbling_late(spark, sf_dir):
    t, slices = _slices(spark, sf_dir)
    return replay.drain(spark, {"t": t}, lambda t: windows.per_minute(t, watermark="5 minutes"), slices={"t": slices})


@query(_late_sql(_SLIDING))
def stream_sliding_late(spark, sf_dir):
    t, slices = _slices(spark, sf_dir)
    return replay.drain(spark, {"t": t}, lambda t: windows.five_minutes_sliding(t, watermark="5 minutes"), slices={"t": slices})


@query(_late_sql(_TUMBLING))
def stream_tumbling_resumed(spark, sf_dir):
    """Stopped after the first and the third micro-batch; offsets, state and watermark go on from the checkpoint."""
    t, slices = _slices(spark, sf_dir)
    return replay.drain(spark, {"t": t}, lambda t: windows.per_minute(t, watermark="5 minutes"), slices={"t": slices}, stops=(1, 3))


@query(f"WITH {_T}, {_C} {_HIGH.format(at=_AT)}")
def stream_high_value_resumed(spark, sf_dir):
    """Each file once, over two stops."""
    t, slices = _slices(spark, sf_dir)
    customers = views.customers(spark, sf_dir)
    return replay.drain(spark, {"t": t}, lambda t: alerts.high_value_alerts(t, customers, _now()), slices={"t": slices}, stops=(1, 2))


# -- the whole flow, and sinks that keep what they send

_SILVER_T = f"t AS (SELECT * REPLACE (date_trunc('millisecond', transaction_timestamp) AS transaction_timestamp) FROM ({views.SQL['transactions']}) WHERE CAST(substr(transaction_id, 4) AS BIGINT) % {views.BROKEN} <> 0 AND CAST(substr(transaction_id, 4) AS BIGINT) % {views.NO_CARD} <> 0)"
_SILVER_SLIDING = "SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, count(*) AS transaction_count FROM (SELECT date_trunc('minute', transaction_timestamp) - to_minutes(k) AS window_start FROM t, (SELECT unnest(range(5)) AS k)) GROUP BY ALL"
_SILVER_CLOSED = "SELECT * FROM ({}) WHERE window_end <= (SELECT max(transaction_timestamp) - INTERVAL 5 MINUTE FROM t)"
_MEDALLION = f"""SELECT 'bronze_transactions' AS dataset, printf('TXN%07d', event_id) AS key, 'transactions' AS topic, CAST(event_id AS BIGINT) AS "offset", CAST(ts AS TIMESTAMP) AS "timestamp", event_id % {views.BROKEN} <> 0 AS valid FROM events
UNION ALL BY NAME SELECT 'bronze_watchlist' AS dataset, * RENAME (effective_from AS listed_from), 'f' AS source_file FROM ({views.SQL['watchlist']})
UNION ALL BY NAME SELECT 'silver_transactions' AS dataset, * FROM t
UNION ALL BY NAME SELECT 'silver_watchlist' AS dataset, *, 'f' AS source_file FROM w
UNION ALL BY NAME SELECT 'silver_customers' AS dataset, * REPLACE (CAST(try_strptime(account_open_date, '%Y-%m-%d') AS DATE) AS account_open_date) FROM ({views.SQL['customers']})
UNION ALL BY NAME SELECT 'high_value_alerts' AS dataset, * EXCLUDE (alert_timestamp) FROM (@high)
UNION ALL BY NAME SELECT 'fraud_card_alerts' AS dataset, * EXCLUDE (alert_timestamp) FROM (@fraud)
UNION ALL BY NAME SELECT 'transactions_per_minute' AS dataset, * FROM ({_SILVER_CLOSED.format(_TUMBLING.removeprefix(f'WITH {_T} '))})
UNION ALL BY NAME SELECT 'transactions_sliding' AS dataset, * FROM ({_SILVER_CLOSED.format(_SILVER_SLIDING)})"""


def _medallion_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """The rows of all nine tables under one another, without the times of processing and what Kafka's are always."""
    out = []
    for name, rows in tables.items():
        if name == "bronze_transactions":
            rows = rows.select("key", "topic", "offset", "timestamp", text.is_json(F.col("value")).alias("valid"))
        elif name == "bronze_watchlist":
            rows = rows.withColumnRenamed("effective_from", "listed_from").drop("_rescued_data")
        gone = [c for c in rows.columns if c == "alert_timestamp" or c.startswith("kafka_") or c.endswith("ingestion_timestamp")]
        out.append(rows.drop(*gone).withColumn("dataset", F.lit(name)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), out)


def _medallion_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"transaction_messages": views.messages(spark, sf_dir), "watchlist_files": views.watchlist(spark, sf_dir).withColumn("source_file", F.lit("f")), "customer_profiles": views.customers(spark, sf_dir)}


@query(f"WITH {_SILVER_T}, {_C}, {_W} {_MEDALLION.replace('@high', _HIGH.format(at=_AT)).replace('@fraud', _FRAUD.format(at=_AT, c='c'))}")
def medallion_tables(spark, sf_dir):
    """All datasets as streams that append to tables, each reading the ones before it, to the end of what is there."""
    root, inputs = scratch_path(spark, "medallion"), {}
    for name, df in _medallion_inputs(spark, sf_dir).items():
        inputs[name] = (f"{root}/in/{name}", df.schema)
        df.write.parquet(f"{root}/in/{name}")
    line = pipeline.Pipeline(spark, medallion.build(), pipeline.Settings("medallion", root), inputs)
    line.run()
    return _medallion_rows({d.name: line.table(d.name) for d in line.registry.order()})


def _sent(spark: SparkSession, alerts_df: DataFrame, write: Callable[[DataFrame, int], None], times: int = 1) -> None:
    """Gives a sink the alerts in three micro-batches, by the last digit of their transaction; again and again if need be."""
    digit, at = F.right("transaction_id", F.lit(1)).cast("int"), scratch_path(spark, "alerts")
    alerts_df.write.parquet(at)  # else each turn joins all over again, and the driver gets the broadcast side each time
    kept = spark.read.schema(alerts_df.schema).parquet(at)
    for _ in range(times):
        replay.in_turns(spark, {"a": kept.schema}, lambda a: a, [{"a": kept.filter(digit % 3 == k)} for k in range(3)], write=write)


@query(f"WITH {_T}, {_C} SELECT count(*) || ' high-value transaction alert' || CASE WHEN count(*) = 1 THEN '' ELSE 's' END AS subject, count(*) AS listed FROM ({_HIGH.format(at=_AT)}) GROUP BY CAST(right(transaction_id, 1) AS INTEGER) % 3")
def digest_mails(spark, sf_dir):
    """One mail for each micro-batch, with all of its alerts, composed and sent by executors."""
    box = outbox.Outbox(spark, scratch_path(spark, "outbox"), sinks.MemoryNotifier())
    _sent(spark, _high(spark, sf_dir), box.digest("ops@example.com", mail_rows=1 << 40))
    return box.journal().filter("outcome = 'sent'").select(F.col("mail_subject").alias("subject"), F.col("alerts").alias("listed"))


_SENT = f"SELECT * FROM ({_FRAUD.format(at=_AT, c='half')}) WHERE customer_email IS NOT NULL"


@query(f"WITH {_T}, {_C}, {_W}, half AS (SELECT * FROM c WHERE risk_score < 50) SELECT customer_email AS mail_to, 'Card alert: ' || risk_level || ' risk, ' || alert_id AS mail_subject FROM ({_SENT})")
def customer_mails(spark, sf_dir):
    """One mail for each alert whose customer is known, though all batches come twice; executors send them."""
    box = outbox.Outbox(spark, scratch_path(spark, "outbox"), sinks.MemoryNotifier())
    _sent(spark, _fraud(spark, sf_dir, known="risk_score < 50"), box.mails(), times=2)
    return box.journal().filter("outcome = 'sent'").select("mail_to", "mail_subject")


@query(f"WITH {_T}, {_C}, {_W}, half AS (SELECT * FROM c WHERE risk_score < 50), a AS ({_FRAUD.format(at=_AT, c='half')}) SELECT count(*) FILTER (customer_email IS NOT NULL AND NOT bad) AS sent, count(*) FILTER (customer_email IS NOT NULL AND bad) AS failed, count(*) FILTER (customer_email IS NULL) AS skipped FROM (SELECT *, customer_email IN (SELECT min(email) FROM half) AS bad FROM a)")
def mail_counters(spark, sf_dir):
    """One address fails; customers without one are skipped."""
    known = views.customers(spark, sf_dir).filter("risk_score < 50")
    bad = known.agg(F.min("email")).first()[0]
    box = outbox.Outbox(spark, scratch_path(spark, "outbox"), sinks.MemoryNotifier(failing=frozenset([bad])))
    _sent(spark, _fraud(spark, sf_dir, known="risk_score < 50"), box.mails())
    return box.counters().agg(*[F.sum(o).alias(o) for o in ("sent", "failed", "skipped")])


@query(
    f"""WITH {_T}, {_C}, n AS (SELECT count(*) AS n, (count(*) + 499) // 500 AS pages FROM ({_HIGH.format(at=_AT)}) GROUP BY CAST(right(transaction_id, 1) AS INTEGER) % 3), p AS (SELECT *, unnest(range(1, pages + 1)) AS page FROM n)
SELECT n || ' high-value transaction alert' || CASE WHEN n = 1 THEN '' ELSE 's' END || CASE WHEN pages > 1 THEN ' (' || page || ' of ' || pages || ')' ELSE '' END AS subject, least(500, n - 500 * (page - 1)) AS listed FROM p"""
)
def digest_pages(spark, sf_dir):
    """Mails of 500 alerts at most for each micro-batch, composed and sent by executors, though all batches come twice."""
    box = outbox.Outbox(spark, scratch_path(spark, "outbox"), sinks.MemoryNotifier())
    _sent(spark, _high(spark, sf_dir), box.digest("ops@example.com", mail_rows=500), times=2)
    return box.journal().filter("outcome = 'sent'").select(F.col("mail_subject").alias("subject"), F.col("alerts").alias("listed"))


from vigilake.plans import stream_catalog  # noqa: E402, F401  registers its queries here
