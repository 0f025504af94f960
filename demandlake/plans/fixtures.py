"""Input tables derived from the driver's TPC-H-like tables.

The application's own input (a daily sales CSV) is not shipped, so the
registered queries build the same shapes from ``lineitem``, ``orders``,
``supplier``, ``nation``, ``part`` and ``events``.  Every fixture is a
lazy DataFrame over the whole tables; its work grows with them.

Joins are written plainly and left to Catalyst/AQE: the dimension sides
(``nation``: 25 rows; ``supplier``/``part`` grow with the data) are
broadcast only when AQE measures them under the broadcast threshold,
otherwise the join is a sort-merge join with AQE skew splitting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake.config import BASELINE, CHALLENGER


#: Tables behind ``bronze_dirty``.
SALES_TABLES = ("lineitem", "orders", "supplier", "part")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _line_dims(spark: SparkSession, sf_dir: str, li: DataFrame) -> DataFrame:
    sup = table(spark, sf_dir, "supplier").select("s_suppkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return (
        li.join(sup, li.l_suppkey == sup.s_suppkey)
        .join(part, li.l_partkey == part.p_partkey)
    )


def sales_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean daily sales: (date, store, item, sales), unique per key.

    store = supplier, item = part type, sales = quantity sum; the number of
    series grows with the suppliers.
    The aggregation is partial-then-final, so hot keys are combined on the
    map side before the shuffle."""
    li = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_suppkey", "l_partkey", "l_quantity")
    j = _line_dims(spark, sf_dir, li)
    return j.groupBy(
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_suppkey").cast("string").alias("store"),
        F.col("p_type").alias("item"),
    ).agg(F.sum("l_quantity").cast("int").alias("sales"))


def bronze_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped rows with several versions per key and dirt: NULL
    dates, keys, sales and promo fields, negative sales; the order date is
    the load time.  Identifying line columns ride along as tie-breakers."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_discount", "l_returnflag", "l_shipdate",
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = _line_dims(spark, sf_dir, li.join(orders, li.l_orderkey == orders.o_orderkey))
    k = F.col("l_orderkey")
    qty = F.col("l_quantity").cast("int")
    no_promo = F.col("l_linenumber") % 3 == 0
    return j.select(
        F.when(k % 97 == 0, F.lit(None)).otherwise(F.col("l_shipdate").cast("date")).alias("date"),
        F.when(k % 89 == 0, F.lit(None)).otherwise(F.col("l_suppkey").cast("string")).alias("store"),
        F.when(k % 83 == 0, F.lit(None)).otherwise(F.col("p_type")).alias("item"),
        F.when(k % 71 == 0, F.lit(None).cast("int"))
        .when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") % 2 == 0), -qty)
        .otherwise(qty)
        .alias("sales"),
        F.col("o_orderdate").alias("ingestion_timestamp"),
        F.when(no_promo, F.lit(None).cast("int"))
        .when(F.col("l_discount") > 0.08, F.lit(1))
        .otherwise(F.lit(0))
        .alias("is_promo"),
        F.when(no_promo, F.lit(None).cast("double"))
        .when(F.col("l_discount") > 0.08, F.col("l_discount") * 0.3)
        .otherwise(F.lit(0.0))
        .alias("discount_pct"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
    )


def raw_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw, all-STRING sales rows (as a header CSV arrives) with malformed
    dates, malformed and decimal sales mixed in.  Keys are integer ids as text."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey", "l_quantity", "l_shipdate")
    k = F.col("l_orderkey")
    return li.select(
        F.when(k % 97 == 0, F.lit("not-a-date"))
        .otherwise(F.col("l_shipdate").cast("date").cast("string"))
        .alias("date"),
        F.col("l_suppkey").cast("string").alias("store"),
        F.col("l_partkey").cast("string").alias("item"),
        F.when(k % 89 == 0, F.lit("x"))
        .when(k % 5 == 0, F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(".99999999999")))  # longer than a cast could round
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
        .alias("sales"),
    )


def model_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run registry: many runs, both roles, two environments."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("run_"), F.col("o_orderkey").cast("string")).alias("run_id"),
        F.col("o_orderdate").alias("start_time"),
        F.when(F.col("o_custkey") % 2 == 0, "DEV").otherwise("PROD").alias("env"),
        F.when(F.col("o_orderkey") % 2 == 0, BASELINE).otherwise(CHALLENGER).alias("model_role"),
        (F.col("o_totalprice") / 1000).alias("mae"),
    )


def model_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An append-only pointer log: which run was made active, and when."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.when(F.col("o_orderkey") % 2 == 0, BASELINE).otherwise(CHALLENGER).alias("active_model"),
        F.concat(F.lit("run_"), F.col("o_orderkey").cast("string")).alias("model_run_id"),
        F.lit(None).cast("string").alias("reason"),
        F.col("o_orderdate").alias("decision_timestamp"),
    )


_EVENT_FEATURE = {
    "view": "is_promo",
    "click": "discount_pct",
    "purchase": "sales_lag_7",
    "signup": "sales_lag_28",
}


def drift_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drift-metrics history: one batch per day, one PSI row per feature."""
    e = table(spark, sf_dir, "events")
    feature = F.lit("sales_roll_mean_7")
    for ev, feat in reversed(list(_EVENT_FEATURE.items())):
        feature = F.when(F.col("event_type") == ev, F.lit(feat)).otherwise(feature)
    day = F.col("ts").cast("date")
    return (
        e.groupBy(F.col("event_type"), day.alias("_day"))
        .agg(F.max("value").alias("_mx"))
        .select(
            feature.alias("feature"),
            (F.col("_mx") / 1000).alias("psi"),
            F.col("_day").cast("timestamp_ntz").alias("evaluation_timestamp"),
        )
    )


# Deterministic dedup order for bronze_dirty: newest load first, then the
# line identity, then the cleaned values themselves.
def dirty_tie_breakers():
    return [
        F.col("l_orderkey").desc(),
        F.col("l_linenumber").desc(),
        F.col("l_partkey").desc(),
        F.col("l_suppkey").desc(),
        F.col("sales").desc_nulls_last(),
        F.col("is_promo").desc_nulls_last(),
        F.col("discount_pct").desc_nulls_last(),
    ]
