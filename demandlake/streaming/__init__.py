"""Structured Streaming entry points (incremental bronze ingestion)."""

from demandlake.streaming.ingest import raw_schema, start_bronze_stream

__all__ = ["raw_schema", "start_bronze_stream"]
