"""Files of a shared file system, as the driver handles them: pointers, renames, small texts."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def make_folder(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    fs.mkdirs(p)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what is in a folder, sorted; none if it isn't there. Names that begin with a dot are left out."""
    fs, p = _at(spark, folder)
    return sorted(n for s in fs.listStatus(p) if not (n := s.getPath().getName()).startswith(".")) if fs.exists(p) else []


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file or folder; its parent is made. A target that is there is an error."""
    fs, p = _at(spark, target)
    fs.mkdirs(p.getParent())
    if fs.exists(p) or not fs.rename(_at(spark, source)[1], p):
        raise FileExistsError(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def create(spark: SparkSession, path: str, text: str = "") -> bool:
    """Writes a small file if there is none of that name yet; False if there is. Of two that try at once, one succeeds."""
    fs, p = _at(spark, path)
    fs.mkdirs(p.getParent())
    try:
        out = fs.create(p, False)
    except Exception as e:
        if exists(spark, path):
            return False
        raise e
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def replace(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file, in place of one of that name."""
    fs, p = _at(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
