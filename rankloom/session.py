"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

# What the operators rely on; all of them can be set on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to ``spark`` and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    ``spark.checkpoint.dir`` or the checkpoint folder of the context; a session
    that names neither keeps its intermediate tables below its warehouse. Where that
    is a folder of each machine, a session on several machines has to name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    target = spark._jvm.org.apache.hadoop.fs.Path(warehouse)
    scheme = target.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme()
    if scheme == "file" and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse.rstrip('/')}/_rankloom"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; never reused, removed when Python ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(remove, spark, path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table of the shared folder that nothing reads any more."""
    with contextlib.suppress(Exception):  # the JVM may be gone already
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stored(df: DataFrame, name: str = "table", path: str | None = None) -> DataFrame:
    """``df`` computed once, written as Parquet to the shared folder (or ``path`` in it) and read back.

    For intermediate results that several later passes read: an executor that
    is lost takes nothing with it, and later passes read only their columns.
    The shuffle files behind it go as soon as it is written, as nothing reads them again.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_SHUFFLE_CLEANUP) if before is None else spark.conf.set(_SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def settled(df: DataFrame) -> DataFrame:
    """A small result computed once for several later passes."""
    return stored(df, "settled")
