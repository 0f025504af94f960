"""Declared table contracts (one ``StructType`` per table) and schema tools."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_REQUIRED = ("date", "store", "item", "sales")

BRONZE = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("store", T.StringType()),
        T.StructField("item", T.StringType()),
        T.StructField("sales", T.IntegerType()),
        T.StructField("ingestion_timestamp", T.TimestampType()),
        T.StructField("is_promo", T.IntegerType()),
        T.StructField("discount_pct", T.DoubleType()),
    ]
)

GOLD = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("store", T.StringType()),
        T.StructField("item", T.StringType()),
        T.StructField("sales", T.IntegerType()),
        T.StructField("is_promo", T.IntegerType()),
        T.StructField("discount_pct", T.DoubleType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("week_of_year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("sales_lag_7", T.IntegerType()),
        T.StructField("sales_lag_14", T.IntegerType()),
        T.StructField("sales_lag_28", T.IntegerType()),
        T.StructField("sales_roll_mean_7", T.DoubleType()),
        T.StructField("sales_roll_mean_28", T.DoubleType()),
    ]
)

MODEL_RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("env", T.StringType()),
        T.StructField("model_role", T.StringType()),
        T.StructField("model_type", T.StringType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("features", T.StringType()),
        T.StructField("mae", T.DoubleType()),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("model_path", T.StringType()),
    ]
)

MODEL_DECISIONS = T.StructType(
    [
        T.StructField("active_model", T.StringType()),
        T.StructField("model_run_id", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("decision_timestamp", T.TimestampType()),
    ]
)

PERFORMANCE = T.StructType(
    [
        T.StructField("active_model", T.StringType(), False),
        T.StructField("baseline_mae", T.DoubleType(), False),
        T.StructField("active_model_mae", T.DoubleType(), False),
        T.StructField("degradation_pct", T.DoubleType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("evaluation_timestamp", T.TimestampType(), False),
    ]
)

DRIFT = T.StructType(
    [
        T.StructField("feature", T.StringType()),
        T.StructField("psi", T.DoubleType()),
        T.StructField("evaluation_timestamp", T.TimestampType()),
    ]
)

ALERTS = T.StructType(
    [
        T.StructField("feature", T.StringType()),
        T.StructField("metric_value", T.DoubleType()),
        T.StructField("severity", T.StringType()),
        T.StructField("alert_type", T.StringType()),
        T.StructField("alert_timestamp", T.TimestampType()),
    ]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto a declared contract: names, order and types.

    Non-nullable fields are checked inside the plan: a NULL raises at run
    time through ``assert_true`` instead of being silently written.
    """
    cols = []
    for f in schema.fields:
        c = F.col(f.name).cast(f.dataType)
        if not f.nullable:
            c = F.when(
                F.assert_true(c.isNotNull(), F.lit(f"NULL in non-nullable column {f.name}")).isNull(), c
            )
        cols.append(c.alias(f.name))
    return df.select(*cols)


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty DataFrame carrying a declared schema."""
    return spark.createDataFrame([], schema)


LAYER_CHECKS = T.StructType(
    [
        T.StructField("layer", T.StringType()),
        T.StructField("check", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)


def describe(df: DataFrame) -> DataFrame:
    """``DESCRIBE TABLE`` as a DataFrame: (col_pos, col_name, data_type)."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "col_pos int, col_name string, data_type string")


def profile(df: DataFrame) -> DataFrame:
    """``describe`` with what the columns hold: (col_pos, col_name,
    data_type, n_rows, n_values, n_distinct), counted by Spark in one pass
    over the whole table; the distinct count is exact."""
    fields = list(enumerate(df.schema.fields))
    counts = [F.count(F.col(f.name)).alias(f"v{i}") for i, f in fields] + [F.count_distinct(F.col(f.name)).alias(f"d{i}") for i, f in fields]
    cells = [
        F.struct(
            F.lit(i).alias("col_pos"), F.lit(f.name).alias("col_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("n_rows"), F.col(f"v{i}").alias("n_values"), F.col(f"d{i}").alias("n_distinct"),
        )
        for i, f in fields
    ]
    one = df.agg(F.count(F.lit(1)).alias("n_rows"), *counts)
    return one.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
