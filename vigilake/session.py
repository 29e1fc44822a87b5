"""A session with the settings that the engine relies on, and a scratch folder that executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession


def session(name: str = "vigilake", master: str | None = None, **conf: str) -> SparkSession:
    """UTC timestamps and adaptive execution; other settings as given (`__` for a dot), or as the cluster has them."""
    b = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    if master:
        b = b.master(master)
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir; where that is unset and one machine does all, below a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = f"{tempfile.gettempdir()}/vigilake-checkpoints"
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/vigilake/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


#: Scratch paths, which are removed when the driver ends: what a query returned is read lazily until then.
_made: list[tuple[SparkSession, str]] = []


@atexit.register
def _clean() -> None:
    from vigilake import storage

    for spark, path in _made:
        if spark.sparkContext._jsc is not None:
            storage.delete(spark, path)
