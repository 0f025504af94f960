"""Schemas, readers, writers and the shared storage folder."""

from demandlake.sources import io, schemas, storage

__all__ = ["io", "schemas", "storage"]
