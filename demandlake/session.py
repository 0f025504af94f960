"""Session helper for tests, the bench and local runs.

A cluster job should use the session it is given; this helper only
builds a local one.  The shared folder stays whatever the environment
names in ``spark.checkpoint.dir``; only when none is named does a local
session get a folder of its own (see ``sources.storage``).
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from demandlake.sources import storage


def get_session(app: str = "demandlake", cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("DEMANDLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    storage.shared_root(spark)  # the environment's spark.checkpoint.dir, or a local folder if none is named
    return spark
