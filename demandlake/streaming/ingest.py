"""Incremental bronze ingestion with Structured Streaming.

New raw CSV files landing in a folder are typed, shifted, stamped with
their micro-batch time and appended to the bronze table; the stream's
checkpoint lives in the shared folder, so a restarted driver resumes
where it stopped and no file is loaded twice.  With
``trigger(availableNow=True)`` the same code runs as a scheduled batch
job over whatever arrived since the last run.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from demandlake.operators import bronze
from demandlake.sources import schemas


def raw_schema(spark: SparkSession, raw_dir: str) -> T.StructType:
    """All-STRING schema from the header of the files already present."""
    header = spark.read.option("header", True).csv(raw_dir).columns
    missing = [c for c in schemas.RAW_REQUIRED if c not in header]
    if missing:
        raise ValueError(f"raw files in {raw_dir} lack required columns {missing}")
    return T.StructType([T.StructField(c, T.StringType()) for c in header])


def start_bronze_stream(
    spark: SparkSession,
    raw_dir: str,
    bronze_path: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    with_promo: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """``checkpoint`` defaults to a folder beside the target, so a restart of
    the same ingestion finds it."""
    reader = spark.readStream.option("header", True).option("enforceSchema", False).schema(raw_schema(spark, raw_dir))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    out = bronze.ingest(reader.csv(raw_dir), with_promo=with_promo)
    w = (
        out.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint or f"{bronze_path.rstrip('/')}.checkpoint")
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(bronze_path)
