"""Measures of running streams, kept as a table: rows, rates, expectation counts, rows behind the watermark, per batch."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import QueryIdleEvent, QueryProgressEvent, QueryStartedEvent, QueryTerminatedEvent, StreamingQueryListener

from vigilake import storage

SCHEMA = "query string, query_id string, batch_id long, measure string, value double"


class Measures(StreamingQueryListener):
    """A listener that writes what each batch of every query of the session says about itself.

    A batch's measures are one small file, named by the query (whose id is in its checkpoint) and the batch: a batch that is
    run again counts once, with the run that took more rows. Counts of observe() are named `observation.count`."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._ended: set[str] = set()
        self._end = threading.Condition()

    def __enter__(self) -> Measures:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_: object) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        pass

    def onQueryIdle(self, event: QueryIdleEvent) -> None:
        pass

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        p = event.progress
        found: dict[str, float | None] = {
            "input_rows": p.numInputRows,
            "input_rows_per_second": p.inputRowsPerSecond,
            "processed_rows_per_second": p.processedRowsPerSecond,
            "duration_ms": p.batchDuration,
            "state_rows": sum(s.numRowsTotal for s in p.stateOperators),
            "rows_behind_watermark": sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
        }
        for name, row in p.observedMetrics.items():
            found |= {f"{name}.{k}": v for k, v in row.asDict().items()}
        lines = [json.dumps({"query": p.name, "query_id": str(p.id), "batch_id": p.batchId, "measure": k, "value": float(v)}) for k, v in found.items() if isinstance(v, (int, float)) and v == v and abs(v) != float("inf")]
        at = f"{self.path}/{p.id}/batch-{p.batchId:012d}.json"
        storage.make_folder(self.spark, f"{self.path}/{p.id}")
        if storage.exists(self.spark, at):
            before = next(r["value"] for r in map(json.loads, storage.text(self.spark, at).splitlines()) if r["measure"] == "input_rows")
            if before >= max(1, p.numInputRows):  # run again, and maybe skipped by a sink that had it: the first run tells more
                return
        storage.replace(self.spark, at, "\n".join(lines) + "\n")

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        with self._end:
            self._ended.add(str(event.runId))
            self._end.notify_all()

    def wait(self, run_id: str, timeout: float = 60) -> None:
        """Until all is written that a query which has ended reported; events come after it."""
        with self._end:
            if not self._end.wait_for(lambda: str(run_id) in self._ended, timeout):
                raise TimeoutError(f"no end of {run_id} within {timeout} seconds")

    def table(self) -> DataFrame:
        """query, query_id, batch_id, measure, value."""
        storage.make_folder(self.spark, self.path)
        return self.spark.read.schema(SCHEMA).option("recursiveFileLookup", True).json(self.path)
