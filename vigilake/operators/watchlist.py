"""The watchlist's feed: which rows are still to be sent, and files of one row each."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vigilake import storage
from vigilake.functions.text import number_suffix


def last_number(sent: DataFrame, prefix: str = "WL") -> DataFrame:
    """last: the greatest number among ids already sent; 0 if there is none. One row."""
    return sent.agg(F.coalesce(F.max(number_suffix(F.col("watchlist_id"), prefix)), F.lit(0).cast("long")).alias("last"))


def still_to_send(seed: DataFrame, sent: DataFrame, prefix: str = "WL") -> DataFrame:
    """Rows of seed whose number is above all sent ones; ids of another form are not sent."""
    last = last_number(sent, prefix)
    return seed.withColumn("__n", number_suffix(F.col("watchlist_id"), prefix)).join(F.broadcast(last), F.col("__n") > F.col("last")).drop("__n", "last")


def write_drip(rows: DataFrame, path: str, rows_per_file: int = 1) -> None:
    """JSON files of rows_per_file rows at most, in the order of ids."""
    rows.orderBy("watchlist_id").write.option("maxRecordsPerFile", rows_per_file).mode("append").json(path)


def drip(rows: DataFrame, path: str, seconds: float = 5.0, stamp: str | None = None, first: int = 1) -> int:
    """A JSON file for each row, in the order of ids: fraud_watchlist_{stamp}_{number}.json; how many.

    seconds: between one file and the next; rows then come to the driver a partition at a time, as a feed of one file every
    few seconds must. With 0 executors write them, all tasks at once. A file appears under its name only when it is whole.
    stamp: of each file's time where none is given."""
    spark, n = rows.sparkSession, 0
    storage.make_folder(spark, path)
    if not seconds and _writable(path):
        return _drip_at_once(rows, path, stamp, first)
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for r in rows.orderBy("watchlist_id").select(F.to_json(F.struct(*rows.columns)).alias("json")).toLocalIterator():
        if n and seconds:
            time.sleep(seconds)
        name = _name(stamp, first + n)
        part = jvm.org.apache.hadoop.fs.Path(f"{path}/_{name}.part")
        out = fs.create(part, True)
        out.write(bytearray(r.json + "\n", "utf-8"))
        out.close()
        fs.rename(part, jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"))
        n += 1
    return n


def _name(stamp: str | None, number: int) -> str:
    return f"fraud_watchlist_{stamp or time.strftime('%Y%m%d%H%M%S', time.gmtime())}_{number}.json"


def _writable(path: str) -> bool:
    """Whether Python on the executors reaches a path: local and object stores and HDFS; not Hadoop's other file systems."""
    try:
        pafs.FileSystem.from_uri(path)
        return True
    except (pa.ArrowException, OSError, ValueError):
        return False


def _drip_at_once(rows: DataFrame, path: str, stamp: str | None, first: int) -> int:
    """Rows are sorted by ranges, written once and numbered by the counts of the ranges; tasks then write their rows' files."""
    spark, staged = rows.sparkSession, f"{path}/_rows-{uuid.uuid4().hex}"
    place = F.monotonically_increasing_id()  # counts a partition's rows in its low 33 bits
    sort = rows.repartitionByRange("watchlist_id").sortWithinPartitions("watchlist_id")
    sort.select(F.to_json(F.struct(*rows.columns)).alias("json"), F.shiftright(place, 33).alias("part"), place.bitwiseAND((1 << 33) - 1).alias("place")).write.parquet(staged)
    kept = spark.read.schema("json string, part long, place long").parquet(staged)
    parts = kept.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row for each partition
    before = parts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    numbered = kept.join(F.broadcast(before), "part").select("json", (F.col("before") + F.col("place") + first).alias("number"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = pafs.FileSystem.from_uri(path)
        for b in batches:
            for json, number in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                name = _name(stamp, number)
                part = f"{at}/_{name}.{uuid.uuid4().hex}.part"  # a task may run twice
                with fs.open_output_stream(part, compression=None) as out:
                    out.write(f"{json}\n".encode())
                fs.move(part, f"{at}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    tasks = spark.sparkContext.defaultParallelism * 4  # a few rows' files are a task's work, however small their table
    n = numbered.repartition(tasks, "number").mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    storage.delete(spark, staged)
    return n
