"""Small control tables that are replaced while they are being read.

A version is a folder of its own.  The manifest, an append-only table of one
row per version, names the current one, and its row is written last: until
then every reader sees the old version, whole, and a failed replacement
leaves only a folder that nothing names.  So a table can be overwritten from
itself, or reset and filled again in one step.

One writer at a time; versions are kept until the store's own rules remove
them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandlake.sources import io, storage

MANIFEST = T.StructType([T.StructField("version", T.LongType()), T.StructField("folder", T.StringType())])


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet"):
        self.spark, self.path, self.schema, self.fmt = spark, path.rstrip("/"), schema, fmt

    def _current(self) -> tuple[int, str] | None:
        if not storage.exists(self.spark, f"{self.path}/manifest"):
            return None
        manifest = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest")
        last = manifest.orderBy(F.col("version").desc(), F.col("folder").desc()).first()
        return (last["version"], last["folder"]) if last else None

    @property
    def version(self) -> int:
        """0 before the first replacement."""
        now = self._current()
        return now[0] if now else 0

    def read(self) -> DataFrame:
        """The current version; a reader keeps it, whatever is committed
        afterwards.  A table without a version is empty."""
        now = self._current()
        if now is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.format(self.fmt).schema(io.nullable(self.schema)).load(f"{self.path}/{now[1]}")

    def replace(self, df: DataFrame) -> DataFrame:
        """Make ``df``, which may read this very table, its content."""
        number = self.version + 1
        folder = f"v{number}-{uuid.uuid4().hex}"
        df.select(*self.schema.names).write.format(self.fmt).save(f"{self.path}/{folder}")
        self._commit(number, folder)
        return self.read()

    def _commit(self, number: int, folder: str) -> None:
        row = self.spark.createDataFrame([(number, folder)], MANIFEST)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
