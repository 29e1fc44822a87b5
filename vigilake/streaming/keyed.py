"""A result that is kept up to date: rows of update-mode aggregates replace those of their key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilake import storage
from vigilake.sources.snapshots import Snapshots


class Keyed:
    """A table of one row for each key, as of the last batch.

    Each batch gives a whole version, numbered by the batch: what is run again finds its version and changes nothing, and a
    reader sees the table of one batch or of the next. It is for results (a dashboard's groups), which are far fewer than rows."""

    def __init__(self, path: str, schema: T.StructType, keys: list[str], keep: int = 3):
        self.versions, self.keys, self.keep = Snapshots(path, schema), keys, keep

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """For foreachBatch."""
        spark, version = batch.sparkSession, batch_id + 1
        done = self.versions.versions(spark)
        if done and done[-1] >= version:
            batch.write.format("noop").mode("overwrite").save()  # the stream's state must go on all the same
            return
        new = batch.select(*self.versions.schema.names)
        if done:
            same = [F.col(f"o.`{k}`").eqNullSafe(F.col(f"n.`{k}`")) for k in self.keys]
            old = self.versions.read(spark, done[-1]).alias("o").join(new.select(*self.keys).alias("n"), same, "left_anti")
            new = old.unionByName(new)
        self.versions.publish(new, self.keep, version)

    def read(self, spark: SparkSession) -> DataFrame:
        return self.versions.read(spark)


def forget_commit(spark: SparkSession, checkpoint: str) -> int:
    """Removes the note that the last batch was done, as a crash before it would have left it; gives the batch's number. It is then run again."""
    last = max((n for n in storage.names(spark, f"{checkpoint}/commits") if n.isdigit()), key=int)
    storage.delete(spark, f"{checkpoint}/commits/{last}")
    return int(last)
