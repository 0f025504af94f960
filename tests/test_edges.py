"""Edges of the layers and control steps: refresh modes on one lake, load
stamps, header order, undefined drift, empty holdouts, named tables, and a
forest that depends on its rows alone."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from demandlake.operators import alerts, models
from demandlake.plans import flows
from demandlake.sources import io, schemas, storage

DAY = dt.date(2013, 6, 1)


def bronze_rows(spark, rows):
    return spark.createDataFrame(
        rows, "date date, store string, item string, sales int, ingestion_timestamp timestamp, is_promo int, discount_pct double"
    )


def load(spark, lake, rows):
    io.write_table(bronze_rows(spark, rows), lake.path("bronze_sales"), "append")


def series(days, stamp, sales=5, store="1", item="a"):
    return [(DAY + dt.timedelta(d), store, item, sales + d, stamp, 0, 0.0) for d in days]


def content(lake, name):
    df = lake.layer(name)
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def rebuilt(spark, lake):
    """A lake of the same bronze rows, built in full."""
    other = flows.Lake(spark, storage.scratch_path(spark, "rebuilt"))
    io.write_table(lake.read("bronze_sales"), other.path("bronze_sales"), "append")
    flows.refresh_silver(other, F.lit(dt.date(2014, 1, 1)))
    flows.refresh_gold(other)
    return other


def test_full_and_incremental_refreshes_mix(spark):
    lake = flows.Lake(spark, storage.scratch_path(spark, "mixed"))
    as_of = dt.date(2014, 1, 1)
    t = dt.datetime(2013, 12, 1)
    load(spark, lake, series(range(60), t) + series(range(60), t, store="2"))
    flows.refresh_silver(lake, F.lit(as_of))
    flows.refresh_gold(lake)
    steps = [
        series([60], t),  # a later load with the newest stamp of the first
        series([61], None),  # a load without a stamp
        series([40], t + dt.timedelta(1), sales=90),  # one day, corrected
    ]
    for k, rows in enumerate(steps):
        load(spark, lake, rows)
        if k == 1:
            flows.refresh_silver(lake, F.lit(as_of))
            flows.refresh_gold(lake)
        else:
            flows.refresh_silver_incremental(lake, as_of)
            flows.refresh_gold_incremental(lake)
        other = rebuilt(spark, lake)
        assert content(lake, "silver_sales") == content(other, "silver_sales")
        assert content(lake, "gold_sales_features") == content(other, "gold_sales_features")
    load(spark, lake, series([62], None))
    flows.refresh_silver_incremental(lake, as_of)
    assert content(lake, "silver_sales") == content(rebuilt(spark, lake), "silver_sales")


def test_layers_have_few_files(spark):
    lake = flows.Lake(spark, storage.scratch_path(spark, "files"))
    load(spark, lake, [r for s in "12345" for r in series(range(90), dt.datetime(2013, 12, 1), store=s)])
    flows.refresh_silver(lake, F.lit(dt.date(2014, 1, 1)))
    months = lake.read("silver_sales").select(flows.STORAGE_MONTH).distinct().count()
    assert months == 3 and len(lake.read("silver_sales").inputFiles()) == months


def test_large_months_are_split_by_their_bytes(spark):
    lake = flows.Lake(spark, storage.scratch_path(spark, "big_month"))
    load(spark, lake, [r for s in range(400) for r in series(range(28), dt.datetime(2013, 12, 1), store=str(s))])
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    first = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        flows.refresh_silver(lake, F.lit(dt.date(2014, 1, 1)))
    finally:
        for k, v in first.items():
            spark.conf.set(k, v)
    by_month = lake.read("silver_sales").groupBy(flows.STORAGE_MONTH).agg(F.count_distinct("_metadata.file_name").alias("n"), F.count(F.lit(1)).alias("r")).collect()
    assert len(by_month) == 1 and by_month[0]["n"] > 2 and by_month[0]["r"] == 400 * 28


def test_header_order_is_never_misread(spark, tmp_path):
    (tmp_path / "a.csv").write_text("date,store,item,sales\n2013-01-01,1,9,8\n")
    (tmp_path / "b.csv").write_text("store,date,sales,item\n2,2013-01-02,7,99\n")
    with pytest.raises(Exception, match="(?i)header"):
        io.read_raw_sales(spark, str(tmp_path)).collect()
    (tmp_path / "b.csv").write_text("date,store,item,sales\n2013-01-02,2,99,7\n")
    assert {r["item"] for r in io.read_raw_sales(spark, str(tmp_path)).collect()} == {"9", "99"}


def test_undefined_drift_never_alerts(spark):
    d = spark.createDataFrame([("is_promo", float("nan")), ("discount_pct", None), ("sales_lag_7", 0.1)], "feature string, psi double")
    assert alerts.drift_alerts(d).count() == 0
    assert alerts.severe_drift(d, by=()).first()["severe_drift"] is False


def test_control_rows_have_no_limit(spark):
    schema = schemas.MODEL_DECISIONS
    row = tuple("x" if f.dataType.simpleString() == "string" else dt.datetime(2013, 1, 1) for f in schema.fields)
    assert io.control_rows(spark, [row] * 1500, schema).count() == 1500


def test_named_table_round_trip(spark):
    name = "sales_by_name"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df = spark.range(5).withColumn("v", F.col("id") * 2)
    path = storage.scratch_path(spark, name)
    io.save_named(df, name, path)
    io.save_named(df, name, path)
    assert io.read_table(spark, None, name).count() == 10
    io.save_named(df, name, path, mode="overwrite")
    assert sorted(r["v"] for r in io.read_table(spark, None, name).collect()) == [0, 2, 4, 6, 8]
    spark.sql(f"DROP TABLE {name}")


def test_forest_depends_on_rows_not_on_layout(spark):
    df = spark.range(400).select(
        (F.col("id") % 7).cast("double").alias("x"), (F.col("id") * 13 % 29).cast("double").alias("z"),
        (F.col("id") % 7 * 3 + F.col("id") * 13 % 29 % 5).cast("double").alias("sales"),
    )
    sums = []
    for parts in (2, 8):
        m = models.feature_matrix(df.repartition(parts), ["x", "z"])
        model = models.fit_challenger(m, num_trees=5, max_depth=4, partitions=4)
        sums.append(sorted(r["prediction"] for r in model.transform(m).collect()))
    assert sums[0] == sums[1]


def test_fit_leaves_the_callers_cache_alone(spark):
    m = models.feature_matrix(spark.range(50).select(F.col("id").cast("double").alias("x"), F.col("id").cast("double").alias("sales")), ["x"]).persist()
    models.fit_challenger(m, num_trees=2, max_depth=2, partitions=2)
    assert m.is_cached and m.storageLevel.useMemory
    m.unpersist()
