"""JSON files whose fields are not declared: inferred from the first ones, kept in a log of schemas, extended as new ones turn up."""

from __future__ import annotations

import json
import logging
import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilake import storage
from vigilake.sources.files import rescued

log = logging.getLogger(__name__)


class SchemaLog:
    """Versions of a schema, a small file each, numbered from 1; of two that add one at once, one succeeds."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def versions(self, spark: SparkSession) -> list[int]:
        return [int(n.removesuffix(".json")) for n in storage.names(spark, self.path)]

    def current(self, spark: SparkSession) -> tuple[int, T.StructType | None]:
        """The last version's number and schema; 0 and None before the first."""
        found = self.versions(spark)
        return (found[-1], T.StructType.fromJson(json.loads(storage.text(spark, f"{self.path}/{found[-1]:06d}.json")))) if found else (0, None)

    def add(self, spark: SparkSession, version: int, schema: T.StructType) -> bool:
        return storage.create(spark, f"{self.path}/{version:06d}.json", schema.json())


def _plain(kind: str) -> str:
    """A variant's type as one that columns have: decimals with a fraction are doubles, whole ones longs, what is only ever null is text."""
    out, at = "", 0
    for token in ("OBJECT<", "VOID"):
        kind = kind.replace(token, {"OBJECT<": "STRUCT<", "VOID": "STRING"}[token])
    while (start := kind.find("DECIMAL(", at)) >= 0:
        end = kind.index(")", start)
        out += kind[at:start] + ("BIGINT" if kind[start + 8 : end].split(",")[1].strip() == "0" else "DOUBLE")
        at = end + 1
    return out + kind[at:]


def infer(lines: DataFrame, line: str = "value") -> T.StructType:
    """The fields of JSON lines, by name, as an aggregate of their variants' types; lines that are no objects say nothing."""
    objects = lines.select(F.try_parse_json(line).alias("v")).filter(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT")))
    kind = objects.agg(F.schema_of_variant_agg("v")).first()[0]
    if kind in (None, "VOID") or kind.startswith("OBJECT<>"):
        return T.StructType()
    return T.StructType(sorted(T.DataType.fromDDL(_plain(kind)).fields, key=lambda f: f.name))


class _NewFields(Exception):
    pass


class EvolvingTable:
    """A table of JSON files, with the fields known so far and _rescued_data.

    The first schema is inferred from the first batch of files. A field that no version has is rescued in the batch in
    which it turns up; a new version is then written and the stream starts again with it. Types never change: a value that
    does not fit its field is rescued. A batch's rows are a folder of their own, which appears at once."""

    def __init__(self, spark: SparkSession, source: str, root: str, declared: T.StructType | None = None):
        self.spark, self.source, self.root = spark, source, root.rstrip("/")
        self.log = SchemaLog(f"{self.root}/schemas")
        storage.make_folder(spark, source)
        if declared is not None and not self.log.versions(spark):
            self.log.add(spark, 1, declared)

    def _write(self, version: int, schema: T.StructType | None):
        def write(batch: DataFrame, batch_id: int) -> None:
            nonlocal version, schema
            spark = batch.sparkSession
            if schema is None:
                schema = infer(batch)
                self.log.add(spark, 1, schema)
                version, schema = self.log.current(spark)
            done = f"{self.root}/table/batch-{batch_id:09d}"
            if storage.exists(spark, done):
                return
            parsed = rescued(batch.withColumnRenamed("value", "__line"), schema, "__line").persist()  # written, then asked for new fields
            staged = f"{self.root}/staged/{uuid.uuid4().hex}"
            try:
                parsed.drop("__line").write.parquet(staged)
                found = infer(parsed.filter("_rescued_data IS NOT NULL"), "__line")
            finally:
                parsed.unpersist()
            new = [f for f in found.fields if f.name not in schema.names]
            if new:
                self.log.add(spark, version + 1, T.StructType([*schema.fields, *new]))
            storage.move(spark, staged, done)
            if new:
                raise _NewFields(", ".join(f.name for f in new))

        return write

    def start(self, files_per_trigger: int | None = None):
        """A query to the end of what is there, with the schema of now."""
        reader = self.spark.readStream
        if files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", files_per_trigger)
        lines = reader.option("recursiveFileLookup", True).text(self.source)
        return lines.writeStream.foreachBatch(self._write(*self.log.current(self.spark))).option("checkpointLocation", f"{self.root}/checkpoint").trigger(availableNow=True).start()

    def take(self, files_per_trigger: int | None = None) -> int:
        """Takes all files that are there; gives how often it started again because of new fields."""
        turns = 0
        while True:
            query = self.start(files_per_trigger)
            try:
                query.awaitTermination()
                return turns
            except StreamingQueryException as e:
                # The batch is there, with its new fields rescued; run again, it finds itself done.
                if _NewFields.__name__ not in str(e):
                    raise
                turns += 1
                log.info("fields turned up: %s", self.log.current(self.spark)[1].simpleString())

    def read(self) -> DataFrame:
        """All rows, in the schema of the last version; fields that a batch did not know yet are null in its rows."""
        schema = self.log.current(self.spark)[1] or T.StructType()
        storage.make_folder(self.spark, f"{self.root}/table")
        return self.spark.read.schema(T.StructType([*schema.fields, T.StructField("_rescued_data", T.StringType())])).option("recursiveFileLookup", True).parquet(f"{self.root}/table")
