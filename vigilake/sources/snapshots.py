"""A table in whole versions: readers see one or the next, never a part of one.

Each version is a folder of its own. It counts from the moment at which its marker, an empty file named by its number, is
made; that is one step on any file system. The current version is the one of the highest marker."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from vigilake import storage


class Snapshots:
    def __init__(self, path: str, schema: T.StructType):
        self.path, self.schema = path.rstrip("/"), schema

    def _folder(self, version: int) -> str:
        return f"{self.path}/versions/{version:09d}"

    def versions(self, spark: SparkSession) -> list[int]:
        return [int(n) for n in storage.names(spark, f"{self.path}/markers")]

    def publish(self, rows: DataFrame, keep: int = 3, version: int | None = None) -> int:
        """Writes rows as the next version and gives its number; of the older ones the last `keep` stay, for readers that still use them.

        Two that publish at once get numbers of their own: rows are written under a name of nobody else, then a number is taken.
        version: the number to take, of which only one that was never published may be there."""
        spark = rows.sparkSession
        staged = f"{self.path}/staged/{spark.sparkContext._jvm.java.util.UUID.randomUUID().toString()}"
        rows.select(*[f"`{n}`" for n in self.schema.names]).write.parquet(staged)
        if version is not None:
            if version in self.versions(spark):
                raise FileExistsError(f"version {version} of {self.path}")
            storage.delete(spark, self._folder(version))
        version = version or 1 + max([0, *[int(n) for n in storage.names(spark, f"{self.path}/versions")]])
        while True:
            try:
                storage.move(spark, staged, self._folder(version))
                break
            except FileExistsError:
                version += 1
        storage.create(spark, f"{self.path}/markers/{version:09d}")
        for old in self.versions(spark)[: -keep - 1]:
            storage.delete(spark, f"{self.path}/markers/{old:09d}")
            storage.delete(spark, self._folder(old))
        return version

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The current version, or the one of that number; no rows before the first one."""
        if version is None:
            version = max(self.versions(spark), default=None)
            if version is None:
                return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(self._folder(version))
