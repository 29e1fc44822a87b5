"""Mails that executors send, and a journal of what became of each.

A micro-batch's mails are dealt to a few tasks, as many as the mail server takes connections, and go out in waves: each is a
job that ends with its outcomes in the journal, a table below a shared folder. Nothing but counts comes to the driver.
A batch that is replayed after a crash sends only mails of which the journal does not say that they were sent or had to be
skipped: at most one wave goes out twice. So does the share of a task that is run again in its wave."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vigilake import storage
from vigilake.functions import render
from vigilake.streaming.sinks import Notifier

log = logging.getLogger(__name__)

#: alerts: how many a mail tells of. outcome: sent, failed or skipped (no address, or sent already).
JOURNAL = "mail_id string, mail_to string, mail_subject string, alerts long, outcome string"
_COLUMNS = ["mail_id", "mail_to", "mail_subject", "alerts", "outcome"]
#: Rows of a digest that are put together at a time.
PIECE = 1000
_PLACES = (1 << 33) - 1  # monotonically_increasing_id() counts a partition's rows in its low 33 bits


def _deliver(notifier: Notifier, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sends mails, sorted by id, one by one; a failure doesn't stop the others."""
    last_sent = None
    for batch in batches:
        outcomes = []
        for i, to, subject, body in zip(batch["mail_id"], batch["mail_to"], batch["mail_subject"], batch["mail_body"]):
            if not to or (i is not None and i == last_sent):
                outcomes.append("skipped")
                continue
            try:
                notifier.send(to, subject, body)
                outcomes.append("sent")
                last_sent = i
            except Exception:
                outcomes.append("failed")
                log.exception("mail %s not sent", i)
        yield batch.assign(outcome=outcomes)[_COLUMNS]


@dataclass(frozen=True)
class Outbox:
    """path: the journal's folder, one for each stream. connections: tasks that send at a time. wave: alerts whose mails go out in one job.

    The notifier goes to the executors, so it must pickle; what it remembers stays there. Speculative execution must be off
    (as it is by default), since it would send mails twice."""

    spark: SparkSession
    path: str
    notifier: Notifier
    connections: int = 8
    wave: int = 10_000

    def mails(self) -> Callable[[DataFrame, int], None]:
        """A foreachBatch function: a mail for each fraud-card alert, to its customer; none without an address."""

        def write(batch: DataFrame, batch_id: int) -> None:
            self.send(render.fraud_mail(batch).select(F.col("alert_id").alias("mail_id"), "mail_to", "mail_subject", "mail_body", F.lit(1).cast("long").alias("alerts")), batch_id)

        return write

    def digest(self, recipient: str, mail_rows: int = 1000) -> Callable[[DataFrame, int], None]:
        """A foreachBatch function: all high-value alerts of a batch, newest first, in mails of mail_rows at most; none for an empty batch.

        Rows are sorted over many tasks and numbered by the counts of their partitions; a mail is composed where its rows
        meet. The same alerts make the same mails, so a replay knows those that were sent."""

        def write(batch: DataFrame, batch_id: int) -> None:
            spark, staged, newest = batch.sparkSession, f"{self.path}/sorted/{batch_id}", (F.desc("transaction_timestamp"), F.asc("alert_id"))
            rows = batch.select("transaction_timestamp", "alert_id", render.digest_row().alias("row")).repartitionByRange(*newest).sortWithinPartitions(*newest)
            rows.select("row", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACES)).alias("place")).write.mode("overwrite").parquet(staged)
            rows = spark.read.schema("row string, part int, place long").parquet(staged)
            parts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row for each partition
            total = parts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
            before = parts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
            number = F.col("before") + F.col("place")
            # Rows meet in pieces of a mail first, so that a mail of any length is put together from a few texts.
            placed = rows.join(F.broadcast(before), "part").select(number.alias("at"), "row")
            pieces = placed.groupBy(F.expr(f"at div {mail_rows}").alias("page"), F.expr(f"at % {mail_rows} div {PIECE}").alias("piece")).agg(F.array_sort(F.collect_list(F.struct("at", "row"))).alias("rows"))
            pieces = pieces.select("page", "piece", F.size("rows").cast("long").alias("n"), F.array_join(F.transform("rows", lambda r: r["row"]), "").alias("text"))
            listed = pieces.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("piece", "text"))).alias("pieces"), F.sum("n").alias("n"))
            mails = -(-total // mail_rows)
            subject = [F.lit(render.digest_subject(total))] + ([F.lit(" ("), F.col("page") + 1, F.lit(f" of {mails})")] if mails > 1 else [])
            body = F.concat(F.lit(f"<table>{render.DIGEST_HEAD}"), F.array_join(F.transform("pieces", lambda r: r["text"]), ""), F.lit("</table>"))
            self.send(listed.select(F.concat_ws("-", F.lit("DIGEST"), F.lit(batch_id), "page").alias("mail_id"), F.lit(recipient).alias("mail_to"), F.concat(*subject).alias("mail_subject"), body.alias("mail_body"), F.col("n").alias("alerts")), batch_id)
            storage.delete(spark, staged)

        return write

    def send(self, mails: DataFrame, batch_id: int) -> None:
        """Sends a batch's mails (mail_id, mail_to, mail_subject, mail_body, alerts), but for those that are done by the journal."""
        at = storage.make_folder(self.spark, f"{self.path}/journal/batch_id={batch_id}")
        done = mails.sparkSession.read.schema(JOURNAL).parquet(at).filter("outcome <> 'failed'").select("mail_id").distinct()
        left = mails.join(done, "mail_id", "left_anti").persist()
        try:
            alerts, n_mails = left.agg(F.coalesce(F.sum("alerts"), F.lit(0)), F.count(F.lit(1))).first()
            waves = min(-(-alerts // self.wave), n_mails)
            for k in range(waves):
                due = left.filter(F.pmod(F.xxhash64("mail_id"), F.lit(waves)) == k)
                sent = due.repartition(self.connections, "mail_id").sortWithinPartitions("mail_id").mapInPandas(partial(_deliver, self.notifier), JOURNAL)
                sent.write.mode("append").parquet(at)
        finally:
            left.unpersist()

    def journal(self) -> DataFrame:
        """A row for each attempt, with its batch_id."""
        at = storage.make_folder(self.spark, f"{self.path}/journal")
        return self.spark.read.schema(f"{JOURNAL}, batch_id long").parquet(at)

    def counters(self) -> DataFrame:
        """batch_id, and attempts that were sent, failed and skipped."""
        return self.journal().groupBy("batch_id").agg(*[F.count_if(F.col("outcome") == o).alias(o) for o in ("sent", "failed", "skipped")])
