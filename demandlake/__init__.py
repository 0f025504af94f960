"""demandlake — daily demand forecasting and model monitoring on Spark.

Every step is a ``DataFrame -> DataFrame`` function; facts never leave the
cluster.  Subpackages:

* ``sources``   – schemas, readers and writers (CSV, Parquet/Delta tables,
  control rows) and the shared storage folder.
* ``functions`` – column expressions (lenient casts, hash buckets, clamps,
  calendar fields, linear scorers).
* ``operators`` – the layer operators: bronze, silver, gold, slices,
  models, monitoring, alerts, registry, checks.
* ``plans``     – fixtures from the driver tables, the two flows and the
  registered query catalogue with its SQL oracles.
* ``streaming`` – incremental bronze ingestion with Structured Streaming.
"""

from demandlake.config import DRIFT_FEATURES, FEATURES

__all__ = ["DRIFT_FEATURES", "FEATURES"]
