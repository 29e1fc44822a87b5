"""Alert sinks for foreachBatch: a digest of each micro-batch, or one mail for each alert.

A notifier is injected; without one a sink fails at once rather than drop alerts. Ids of alerts whose mail was sent are
kept in a ledger, a table in a folder that outlives the driver, so that a batch that is replayed does not send them again."""

from __future__ import annotations

import logging
import smtplib
from collections.abc import Callable
from dataclasses import dataclass, field
from email.mime.text import MIMEText
from itertools import islice
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake import storage
from vigilake.functions import render, text

log = logging.getLogger(__name__)


class Notifier(Protocol):
    def send(self, to: str, subject: str, body: str) -> None: ...


@dataclass
class MemoryNotifier:
    """Keeps what is sent; fails for the given recipients."""

    sent: list[tuple[str, str, str]] = field(default_factory=list)
    failing: frozenset[str] = frozenset()

    def send(self, to: str, subject: str, body: str) -> None:
        if to in self.failing:
            raise OSError(f"cannot deliver to {to}")
        self.sent.append((to, subject, body))


@dataclass(frozen=True)
class SmtpNotifier:
    """HTML mail over SMTP with STARTTLS; errors are raised to the sink."""

    sender: str
    host: str
    password: str = field(repr=False)
    port: int = 587

    def send(self, to: str, subject: str, body: str) -> None:
        message = MIMEText(body, "html")
        message["Subject"], message["From"], message["To"] = subject, self.sender, to
        with smtplib.SMTP(self.host, self.port) as server:
            server.starttls()
            server.login(self.sender, self.password)
            server.sendmail(self.sender, [to], message.as_string())


@dataclass
class Counters:
    sent: int = 0
    failed: int = 0
    skipped: int = 0


def digest_sink(notifier: Notifier, recipient: str, max_rows: int | None = None, counters: Counters | None = None, mail_rows: int = 1000) -> Callable[[DataFrame, int], None]:
    """All high-value alerts of a batch, newest first, to the operator, in mails of at most mail_rows; none for an empty batch.

    Rows are rendered on the executors and come to the driver one partition at a time. Only if max_rows is given, one mail
    lists that many at most and tells the number of the others. A mail that fails is logged and counted, and does not stop
    the others: alerts stay in their table."""
    counters = counters if counters is not None else Counters()

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # it is counted, then sorted
        try:
            send(batch, batch_id)
        finally:
            batch.unpersist()

    def send(batch: DataFrame, batch_id: int) -> None:
        total = batch.count()
        if not total:
            log.info("batch %s has no alerts", batch_id)
            return
        rows = batch.orderBy(F.desc("transaction_timestamp"), "alert_id")
        size = mail_rows if max_rows is None else max_rows
        rows = (rows if max_rows is None else rows.limit(max_rows)).select(render.digest_row().alias("row")).toLocalIterator()
        mails = -(-total // size) if max_rows is None else 1
        turn = 0
        while (some := [r.row for r in islice(rows, size)]) or turn == 0:
            turn += 1
            subject = render.digest_subject(total) + (f" ({turn} of {mails})" if mails > 1 else "")
            more = f"<p>and {total - len(some)} more</p>" if max_rows is not None and total > len(some) else ""
            try:
                notifier.send(recipient, subject, f"<table>{render.DIGEST_HEAD}{''.join(some)}</table>{more}")
                counters.sent += 1
            except OSError:
                counters.failed += 1
                log.exception("digest %s of batch %s not sent", turn, batch_id)

    write.counters = counters
    return write


def _sent_before(spark: SparkSession, ledger: str, batch_id: int) -> DataFrame:
    """What an earlier run of this very batch sent: a small part of the ledger, however long the stream has run."""
    at = f"{ledger}/batch-{batch_id:012d}"
    return spark.read.schema("alert_id string").json(at) if storage.exists(spark, at) else spark.createDataFrame([], "alert_id string")


def mail_sink(notifier: Notifier, counters: Counters | None = None, ledger: str | None = None, every: int = 100) -> Callable[[DataFrame, int], None]:
    """A mail for each fraud-card alert, to its customer.

    One mail after the other goes out from the driver, and alerts come to it a partition at a time: this is for as many
    alerts as one mail server takes. One that fails does not stop the others; customers without an address, and alerts
    that were sent before, are skipped. ledger: a folder of JSON lines for each batch, added to every so many mails:
    after a crash the batch is run again, and at most that many are sent twice. Without one, the sink remembers all
    alerts of all batches while it lives."""
    counters, done = counters if counters is not None else Counters(), set()

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, noted = batch.sparkSession, []

        def note() -> None:
            if ledger is not None and noted:
                spark.createDataFrame([(x,) for x in noted], "alert_id string").coalesce(1).write.mode("append").json(f"{ledger}/batch-{batch_id:012d}")
            noted.clear()

        mails = render.fraud_mail(batch).select("alert_id", "mail_to", "mail_subject", "mail_body")
        if ledger is not None:
            mails = mails.join(_sent_before(spark, ledger, batch_id).distinct().withColumnRenamed("alert_id", "sent_id"), F.col("alert_id") == F.col("sent_id"), "left")
        else:
            mails = mails.withColumn("sent_id", F.lit(None).cast("string"))
        now: set[str] = done if ledger is None else set()
        for m in mails.toLocalIterator():
            if not m.mail_to or m.sent_id is not None or m.alert_id in now:
                counters.skipped += 1
                continue
            try:
                notifier.send(m.mail_to, m.mail_subject, m.mail_body)
            except Exception:
                counters.failed += 1
                log.exception("alert %s of batch %s not sent", m.alert_id, batch_id)
                continue
            counters.sent += 1
            now.add(m.alert_id)
            noted.append(m.alert_id)
            if len(noted) >= every:
                note()
        note()
        log.info("batch %s: %s sent, %s failed, %s skipped so far", batch_id, counters.sent, counters.failed, counters.skipped)

    write.counters = counters
    return write


def console_sink(batch: DataFrame, batch_id: int) -> None:
    """Shows a batch as JSON lines with sorted fields, all of it, a partition at a time."""
    for r in batch.select(text.sorted_json(batch.columns).alias("json")).toLocalIterator():
        print(f"batch {batch_id}: {r.json}")
