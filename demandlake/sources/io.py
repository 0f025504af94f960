"""Readers and writers.

Tables are addressed by path (a folder below a caller-supplied root) or,
when a catalog table of that name exists, by name.  The format is a
parameter: Parquet by default, Delta where its jar is on the classpath.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from demandlake.sources import storage
from demandlake.sources.schemas import RAW_REQUIRED, conform

#: Bytes of input files to a shuffle partition, and of shuffled bytes to a task, while a layer is written.
INPUT_SHARE, SHUFFLE_SHARE = 4 << 20, 16 << 20


def read_raw_sales(spark: SparkSession, path: str, required: Sequence[str] = RAW_REQUIRED) -> DataFrame:
    """CSV with a header, no inference: every column arrives as STRING.

    Columns are named by the header, so extra columns pass through; the
    required ones must be present.  Every file's header is checked against
    the table's: a folder whose files order their columns differently fails
    instead of being read by position.
    """
    df = spark.read.option("header", True).option("inferSchema", False).option("enforceSchema", False).csv(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"raw file {path} lacks required columns {missing}")
    return df


def table_path(root: str, name: str, fmt: str = "parquet") -> str:
    return f"{root.rstrip('/')}/{name}.{fmt}" if fmt == "parquet" else f"{root.rstrip('/')}/{name}"


def read_table(
    spark: SparkSession,
    root: str | None,
    name: str,
    fmt: str = "parquet",
    merge_schema: bool = False,
) -> DataFrame:
    """Scan a table by name: a catalog table if ``root`` is None, else a path."""
    if root is None:
        return spark.table(name)
    reader = spark.read.format(fmt)
    if merge_schema:
        reader = reader.option("mergeSchema", True)
    return reader.load(table_path(root, name, fmt))


@contextmanager
def dealt_by_size(df: DataFrame) -> Iterator[None]:
    """While ``df`` is written: as many shuffle partitions as its input files
    ask for, and no larger shares of a shuffle, so that what a task sorts stays
    the same at any input size and fits its memory.  More partitions or
    smaller shares that the session asks for stay."""
    spark = df.sparkSession
    parts, share = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    first = {c: spark.conf.get(c) for c in (parts, share)}
    n = -(-storage.bytes_of(spark, df.inputFiles()) // INPUT_SHARE)
    as_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    spark.conf.set(parts, str(max(int(first[parts]), n)))
    spark.conf.set(share, str(min(as_bytes(first[share]), SHUFFLE_SHARE)))
    try:
        yield
    finally:
        for c, v in first.items():
            spark.conf.set(c, v)


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """What is made and collected here takes its shuffle files with it, which
    would stay until the driver collects its garbage."""
    gone = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    first = spark.conf.get(gone)
    spark.conf.set(gone, "true")
    try:
        yield
    finally:
        spark.conf.set(gone, first)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    fmt: str = "parquet",
    evolve: bool = False,
    partition_by: Sequence[str] = (),
) -> None:
    """Append or overwrite a table folder.

    ``evolve=True`` allows the appended batch to carry new columns: with
    Parquet each file keeps its own schema and readers merge them
    (``mergeSchema``), with Delta the table schema is widened.
    """
    w = df.write.format(fmt).mode(mode)
    if evolve:
        w = w.option("mergeSchema", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def read_back(spark: SparkSession, path: str, fmt: str = "parquet", merge_schema: bool = False) -> DataFrame:
    reader = spark.read.format(fmt)
    if merge_schema:
        reader = reader.option("mergeSchema", True)
    return reader.load(path)


def statistics(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The table read for minima, maxima and counts: an ungrouped aggregate
    over it comes from the Parquet footers (``PushedAggregation``) and reads
    no rows.  Minima and maxima want a column with a value in every file.

    That needs Spark's second-generation reader, which is chosen when the
    table is opened, so the session's choice for other reads stays as it is."""
    if fmt != "parquet":
        return spark.read.format(fmt).load(path)
    first = spark.conf.get("spark.sql.sources.useV1SourceList")
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")  # concerns that reader alone
    spark.conf.set("spark.sql.sources.useV1SourceList", ",".join(s for s in first.split(",") if s != "parquet"))
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.useV1SourceList", first)


def reset_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> None:
    """Empty a table while keeping its declared schema (overwrite with no rows)."""
    spark.createDataFrame([], schema).write.format(fmt).mode("overwrite").save(path)


def control_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType) -> DataFrame:
    """A few driver-made control rows (a run record, a decision) under a
    declared contract; never used for facts."""
    return conform(spark.createDataFrame(list(rows), schema), schema)


def save_named(df: DataFrame, name: str, path: str | None = None, mode: str = "append", fmt: str = "parquet") -> None:
    """Write a catalog table by name; ``path`` keeps its files in a shared
    folder instead of the warehouse.  ``read_table(root=None)`` reads it."""
    w = df.write.format(fmt).mode(mode)
    (w.option("path", path) if path else w).saveAsTable(name)


def append_if_any(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append a batch; an empty batch writes no files (no-op)."""
    df.write.format(fmt).mode("append").save(path)


def materialize(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Write a layer once to the shared folder and read it back.

    Later passes scan the written table (column pruning, predicate
    pushdown, no recomputation of the lineage), and a lost executor only
    costs re-reading files, never re-running the upstream shuffles."""
    df.write.format(fmt).mode("overwrite").save(path)
    return df.sparkSession.read.format(fmt).schema(nullable(df.schema)).load(path)


def nullable(schema: T.StructType) -> T.StructType:
    """The schema as files return it (every top-level field nullable)."""
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])
