"""Scoring a stream: the state of a customer is the times and cities of the last transactions.

In event time customers are dealt to groups, and their rows wait until the watermark has passed them, and are then taken in order of time and seq, so that
the result is that of the batch version whatever order they come in; late ones are dropped by the watermark. A customer who
goes quiet has no state once the watermark is further on than any rule looks back, which changes no result. Without a
delay rows are scored as they come: in order within a batch, and equal to the batch version where time does not run back
between batches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from vigilake.operators import scoring

_BACK = ("impossible_travel", "velocity_fraud", "card_testing")
#: Rows and microseconds that the rules look back.
LOOK_BACK = max(1, scoring.VELOCITY_COUNT, scoring.TESTING_COUNT)
HORIZON_US = max(scoring.TRAVEL_MINUTES * 60, scoring.VELOCITY_SECONDS, scoring.TESTING_SECONDS) * 1_000_000


def _look_back(past: list[tuple[int, str | None]], us: int, city: str | None, amount: float | None) -> tuple[bool, bool, bool]:
    """The rules of _BACK for a row, after the customer's rows before it."""
    within = lambda n, seconds: len(past) >= n and past[-n][0] >= us - seconds * 1_000_000
    travel = bool(past) and past[-1][1] == scoring.TRAVEL_FROM and city == scoring.TRAVEL_TO and abs(us - past[-1][0]) <= scoring.TRAVEL_MINUTES * 60_000_000
    testing = amount is not None and scoring.TESTING_LOW <= amount <= scoring.TESTING_HIGH and within(scoring.TESTING_COUNT, scoring.TESTING_SECONDS)
    return travel, within(scoring.VELOCITY_COUNT, scoring.VELOCITY_SECONDS), testing


class _History(StatefulProcessor):
    def __init__(self, columns: list[str]):
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.past = handle.getListState("past", T.StructType([T.StructField("us", T.LongType()), T.StructField("city", T.StringType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [r for r in rows if len(r)]
        if not parts:
            return
        batch = pd.concat(parts).sort_values(["us", "seq"], kind="stable")
        past = [tuple(r) for r in self.past.get()]
        out = {c: [] for c in _BACK}
        for us, city, amount in zip(batch["us"].tolist(), batch["city"], batch["amount"].tolist()):
            for c, on in zip(_BACK, _look_back(past, us, city, amount)):
                out[c].append(on)
            past = [*past, (us, city)][-LOOK_BACK:]
        self.past.put(past)
        yield batch.assign(**out)[self.columns]

    def close(self) -> None:
        pass


class _InOrder(StatefulProcessor):
    """The customers of a group: rows wait in `open` until a timer of the watermark; `past` has each one's last rows that were taken.

    A state call is a trip to the JVM, so each is made once for all customers of a group."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.past = handle.getValueState("past", "rows array<struct<customer:string,us:bigint,city:string>>")
        self.open = handle.getListState("open", "customer string, us long, seq long, city string, amount double, row string")

    def _wake(self, us: int) -> None:
        self.handle.registerTimer(-(-us // 1000))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        came = [(r.customer_id, r.us, r.seq, r.city, r.amount, r.row) for r in rows]
        if came:
            self.open.appendList(came)
            self._wake(min(r[1] for r in came))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        until = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = list(self.open.get())
        due = sorted((r for r in waiting if r[1] <= until), key=lambda r: (r[1], r[2] is not None, r[2] or 0))
        found = self.past.get()
        past: dict[str, list[tuple[int, str | None]]] = {}
        for customer, us, city in found[0] if found else []:
            past.setdefault(customer, []).append((us, city))
        for customer, us, _, city, amount, row in due:
            own = past.get(customer, [])
            yield Row(row=row, **dict(zip(_BACK, _look_back(own, us, city, amount))))
            past[customer] = [*own, (us, city)][-LOOK_BACK:]
        kept = {c: own for c, own in past.items() if until <= own[-1][0] + HORIZON_US}
        if not due and len(kept) == len(past):
            return  # a timer whose rows went with an earlier one
        if kept:
            self.past.update(([(c, us, city) for c, own in kept.items() for us, city in own],))
        elif found:
            self.past.clear()
        rest = [r for r in waiting if r[1] > until]
        if due:
            self.open.put(rest) if rest else self.open.clear()
        if wake := [r[1] for r in rest] + [own[-1][0] + HORIZON_US + 1 for own in kept.values()]:
            self._wake(min(wake))

    def close(self) -> None:
        pass


def score_stream(transactions: DataFrame, forced=None, seed: int = 42, delay: str | None = None, groups: int = 4096) -> DataFrame:
    """Scores of a stream that has the columns rule_flags() needs (customer and merchant already looked up).

    delay: rows are scored in event time, and may come that much out of order; each comes out once the watermark has
    passed it. groups: into so many customers are dealt then, to be handled group by group: what a batch costs in trips to the
    state grows with them, not with customers, and a task holds the open rows of one. Rows without customer or time are left out: there is no history to hold them against. State needs the
    RocksDB provider (spark.sql.streaming.stateStore.providerClass)."""
    plain = transactions.filter("customer_id IS NOT NULL AND transaction_timestamp IS NOT NULL")
    timed = plain.withColumn("us", F.unix_micros("transaction_timestamp"))
    if delay:
        # The row itself waits as text; what the rules need stands beside it.
        as_text = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}
        rows = timed.withWatermark("transaction_timestamp", delay).select(F.pmod(F.xxhash64("customer_id"), F.lit(groups)).alias("group"), "customer_id", "transaction_timestamp", "us", F.col("seq").cast("long").alias("seq"), "city", F.col("amount").cast("double").alias("amount"), F.to_json(F.struct(*plain.columns), as_text).alias("row"))
        taken = rows.groupBy("group").transformWithState(_InOrder(), "row string, " + ", ".join(f"{c} boolean" for c in _BACK), "Append", "EventTime")
        flagged = taken.select(F.inline(F.array(F.from_json("row", plain.schema, as_text))), *_BACK)
    else:
        schema = T.StructType([*timed.schema.fields, *[T.StructField(c, T.BooleanType()) for c in _BACK]])
        flagged = timed.groupBy("customer_id").transformWithStateInPandas(_History(schema.names), schema, "Append", "None").drop("us")
    rest = {"high_value_transaction": F.col("amount") > scoring.HIGH_VALUE_AMOUNT, "high_risk_merchant": F.col("merchant_risk") == "HIGH", "blacklisted_merchant": F.col("is_blacklisted"), "international_transaction": F.col("is_international")}
    flagged = flagged.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in rest.items()}).withColumn("new_device", ~F.col("device_id").eqNullSafe(F.col("trusted_device_id")))
    return scoring.fraud_scores(flagged, forced, seed)
