"""File and table sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """Each new JSON file once, with the declared schema; fields that don't fit are null."""
    reader = spark.readStream.schema(schema).option("mode", "PERMISSIVE")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def parquet_stream(spark: SparkSession, path: str, schema: T.StructType | None = None, files_per_trigger: int | None = None) -> DataFrame:
    """Appends to a parquet table, file by file; the schema is the table's where none is given."""
    reader = spark.readStream.schema(schema or spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def csv_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line; types are declared, so that ids keep their leading zeros."""
    return spark.read.schema(schema).option("header", True).csv(path)


_NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")


def _typed(value: Column, kind: T.DataType) -> Column:
    """A field's variant as a column's type, or null where it is of another: numbers in quotes are text, fractions are no whole numbers."""
    if isinstance(kind, T.VariantType):
        return value
    read = F.try_variant_get(value, "$", kind.simpleString())
    is_a = F.schema_of_variant(value)
    if isinstance(kind, (T.IntegralType,)):
        return F.when(is_a == "BIGINT", read)
    if isinstance(kind, (T.FractionalType,)):
        return F.when(F.substring_index(is_a, "(", 1).isin(*_NUMBERS), read)
    if isinstance(kind, T.BooleanType):
        return F.when(is_a == "BOOLEAN", read)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.when(is_a == "STRING", F.try_variant_get(value, "$", "string").try_cast(kind))
    return read


def rescued(lines: DataFrame, schema: T.StructType, line: str = "value") -> DataFrame:
    """The schema's fields of JSON lines, and _rescued_data: JSON text of what did not fit them.

    A line is parsed once, to a variant, from which fields and the rest are taken; batches and streams alike. Unknown fields,
    and known ones whose value has another type, are rescued, so a stream never fails on them. A line that is no JSON object, or
    has a field twice, is rescued whole, as {"_corrupt_record": line}. Null lines have no fields and nothing to rescue. Other
    columns of lines are kept."""
    others = [c for c in lines.columns if c not in schema.names and c != "_rescued_data"]
    # A generator of one row, below which no expression is copied: the parse and each field's value stand in the plan once.
    parsed = lines.select(*[F.col(f"`{c}`").alias(f"o{k}") for k, c in enumerate(others)], F.col(f"`{line}`").alias("line"), F.inline(F.array(F.struct(F.try_variant_get(F.try_parse_json(line), "$", "map<string,variant>").alias("m")))))
    value = lambda n: F.try_element_at("m", F.lit(n))
    fields = parsed.select("*", F.inline(F.array(F.struct(*[_typed(value(f.name), f.dataType).alias(f"f{k}") for k, f in enumerate(schema.fields)], F.lit(0).alias("_")))))
    misfits = [F.when(value(f.name).isNotNull() & ~F.is_variant_null(value(f.name)) & F.col(f"f{k}").isNull(), F.struct(F.lit(f.name).alias("k"), value(f.name).cast("string").alias("v"))) for k, f in enumerate(schema.fields)]
    known = F.map_from_entries(F.array_compact(F.array(*misfits))) if misfits else F.create_map().cast("map<string,string>")
    unknown = F.transform_values(F.map_filter("m", lambda k, _: ~k.isin(*schema.names) if schema.names else F.lit(True)), lambda _, v: v.cast("string"))
    both = F.map_concat(unknown, known)
    broken = F.col("line").isNotNull() & (F.trim("line") != "") & F.col("m").isNull()
    extra = F.when(broken, F.to_json(F.create_map(F.lit("_corrupt_record"), F.col("line")))).when(F.size(both) > 0, F.to_json(both))
    return fields.select(*[F.col(f"f{k}").alias(f.name) for k, f in enumerate(schema.fields)], extra.alias("_rescued_data"), *[F.col(f"o{k}").alias(c) for k, c in enumerate(others)])


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, length, modified of the files below a folder; no content is read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return found.select("path", "length", F.col("modificationTime").alias("modified"))


def head(spark: SparkSession, path: str, size: int = 10_000) -> str:
    """The first bytes of a file, as text; no more is read."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = fs.open(at)
    try:
        return bytes(stream.readNBytes(size)).decode("utf-8", "replace")
    finally:
        stream.close()
