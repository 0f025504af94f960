"""Hands this package's sources to the Python workers of a cluster."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once per application, through Spark's own file distribution: the few
    operators that run Python in tasks need the package there.  The zip holds
    sources only and is a local file of the driver, which serves it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).parents[1]
    path = Path(tempfile.mkdtemp()) / "demandlake_package.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))
    _SHIPPED.add(sc.applicationId)
