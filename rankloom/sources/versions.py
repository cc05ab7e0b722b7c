"""Tables in hash buckets whose versions share the buckets that did not change."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rankloom.session import stored
from rankloom.sources.sinks import upserted

BUCKET = "_bucket"
_MANIFEST = "buckets int, bucket int, path string, columns string"


class BucketedTable:
    """Rows in ``buckets`` buckets by the hash of their key, in numbered versions.

    A version is a manifest that names the folder of every bucket; buckets a new version
    does not touch are named again and not rewritten. The manifest is written last, so a
    version is there whole or not at all, and files of a failed attempt belong to none.
    There is one writer at a time. A bucket is written by one task: choose ``buckets`` so
    that one holds less than about a gigabyte. The number is fixed by the first version.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64):
        self.spark, self.folder = spark, folder.rstrip("/")
        first = self._manifest(1) if self.latest() else []
        self.buckets = first[0]["buckets"] if first else buckets

    def bucket_of(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def latest(self) -> int:
        """The number of the newest version; 0 where there is none."""
        done = self._named(f"{self.folder}/versions/*/_SUCCESS", parents=1)
        return max((int(name) for name in done), default=0)

    def paths(self, version: int | None = None) -> dict[int, str]:
        """The folder of every bucket that has rows."""
        rows = self._manifest(version or self.latest())
        return {r["bucket"]: r["path"] for r in rows if r["bucket"] is not None}

    def read(self, version: int | None = None, only=None) -> DataFrame:
        """The rows of a version (the newest), or those of some buckets; others are not opened."""
        version = version or self.latest()
        if not version:
            raise ValueError(f"{self.folder} holds no version")
        schema = self._schema(version)
        places = [p for b, p in self.paths(version).items() if only is None or b in only]
        return self.spark.read.schema(schema).parquet(*places) if places else self.spark.createDataFrame([], schema)

    def replace(self, rows: DataFrame, touched) -> int:
        """A new version whose ``touched`` buckets hold ``rows`` (with ``_bucket``), and no others."""
        before, schema = self.latest(), rows.drop(BUCKET).schema
        if before and self._schema(before).simpleString() != schema.simpleString():
            raise ValueError(f"the columns are {self._schema(before).simpleString()}, not {schema.simpleString()}")
        place = f"{self.folder}/data/{before + 1}-{uuid.uuid4().hex}"
        rows.repartition(BUCKET).write.partitionBy(BUCKET).parquet(place)
        places = {b: p for b, p in self.paths(before).items() if b not in touched} if before else {}
        for name in self._named(f"{place}/{BUCKET}=*"):
            places[int(name.split("=")[1])] = f"{place}/{name}"
        entries = [(self.buckets, None, None, schema.json())]
        entries += [(self.buckets, bucket, path, None) for bucket, path in sorted(places.items())]
        manifest = self.spark.createDataFrame(entries, _MANIFEST).coalesce(1)
        manifest.write.mode("overwrite").json(f"{self.folder}/versions/{before + 1}")
        return before + 1

    def upsert(self, incoming: DataFrame, key: str = "id") -> set[int]:
        """Put ``incoming`` (with ``file`` and ``pos``) on top and return the buckets it touched.

        Keys are not null. Only the touched buckets are read and written. Without rows
        there is no new version, unless it is the first.
        """
        incoming = stored(incoming, "incoming")
        touched = {r[0] for r in incoming.select(self.bucket_of(key)).distinct().collect()}
        if touched or not self.latest():
            current = self.read(only=touched) if self.latest() else None
            self.replace(upserted(current, incoming, key).withColumn(BUCKET, self.bucket_of(key)), touched)
        return touched

    def _manifest(self, version: int):
        # One row per bucket and one for the columns.
        return self.spark.read.schema(_MANIFEST).json(f"{self.folder}/versions/{version}").collect()

    def _schema(self, version: int) -> T.StructType:
        (columns,) = [r["columns"] for r in self._manifest(version) if r["bucket"] is None]
        return T.StructType.fromJson(json.loads(columns))

    def _named(self, pattern: str, parents: int = 0) -> list[str]:
        """The names of the paths that match, or of a folder above them."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(pattern)
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path) or []
        return [str(f.getPath()).split("/")[-1 - parents] for f in found]
