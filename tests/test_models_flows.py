import datetime as dt
import os

import numpy as np
from pyspark.sql import functions as F

from demandlake import config
from demandlake.operators import models
from demandlake.plans import catalog, fixtures, flows
from demandlake.sources import storage

SF = "/root/testdata/sf0.001"


def test_ols_matches_lstsq(spark):
    m = catalog._train_matrix(spark, SF).persist()
    model = models.fit_baseline(m)
    pdf = m.select(*config.FEATURES, "sales").toPandas()  # small test fixture only
    X = np.column_stack([np.ones(len(pdf)), pdf[list(config.FEATURES)].to_numpy(float)])
    beta, *_ = np.linalg.lstsq(X, pdf["sales"].to_numpy(float), rcond=None)
    assert abs(model.intercept - beta[0]) < 1e-5 * max(1, abs(beta[0]))
    assert np.allclose(model.coefficients.toArray(), beta[1:], rtol=1e-5, atol=1e-6)
    checks = models.normal_equation_check(model, m).collect()
    assert all(r["orthogonal"] for r in checks) and len(checks) == 11


def test_forest_invariants_small(spark):
    m = catalog._train_matrix(spark, SF).persist()
    model = models.fit_challenger(m, num_trees=10, max_depth=5)
    r = models.forest_check(model, m).first()
    assert r["within_label_range"] and r["beats_mean_predictor"]


def test_flows_end_to_end(spark):
    root = storage.scratch_path(spark, "lake")
    raw = storage.scratch_path(spark, "raw_csv")
    facts = fixtures.sales_facts(spark, SF)
    # raw strings as a CSV lands: one file per day range, header, no types
    facts.select(*[F.col(c).cast("string") for c in facts.columns]).write.option("header", True).csv(raw)
    out = flows.training_flow(spark, root, raw, env="DEV", forest={"num_trees": 5, "max_depth": 4})
    lake = flows.Lake(spark, root)
    assert lake.read("gold_sales_features").count() == facts.count()
    fc = lake.read("gold_sales_forecast")
    assert fc.count() > 0 and fc.select("model_run_id").distinct().first()[0] == out["challenger_run_id"]
    decided = flows.select_champion(lake, "DEV")
    assert decided.count() == 1
    mon = flows.monitoring_flow(spark, root, "DEV")
    assert mon["performance"].count() == 1
    assert mon["drift"].count() == len(config.DRIFT_FEATURES)
    assert mon["pointer"].count() == 1
    assert set(mon["alerts"].columns) == {"feature", "metric_value", "severity", "alert_type", "alert_timestamp"}


def test_streaming_ingest(spark, tmp_path):
    from demandlake.streaming import start_bronze_stream
    raw = str(tmp_path / "landing")
    os.makedirs(raw)
    with open(os.path.join(raw, "a.csv"), "w") as fh:
        fh.write("date,store,item,sales\n2013-01-01,1,2,3\n2013-01-02,1,2,bad\n")
    out = storage.scratch_path(spark, "bronze_stream")
    q = start_bronze_stream(spark, raw, out)
    q.awaitTermination(120)
    df = spark.read.parquet(out)
    assert df.count() == 2
    assert df.filter(F.col("sales").isNull()).count() == 1
    assert df.agg(F.max("date")).first()[0] == dt.date(2013, 1, 2) + dt.timedelta(2190)


def test_incremental_silver_equals_full_rebuild(spark):
    import random

    from demandlake.operators import silver
    from demandlake.sources import io

    rnd = random.Random(7)
    root = storage.scratch_path(spark, "lake_inc")
    lake = flows.Lake(spark, root)
    d0 = dt.date(2020, 1, 1)
    schema = ("date date, store string, item string, sales int, ingestion_timestamp timestamp, "
              "is_promo int, discount_pct double")
    as_of = d0 + dt.timedelta(5)
    stamp = dt.datetime(2020, 1, 1)
    for load in range(4):
        rows = []
        for _ in range(60):
            stamp += dt.timedelta(minutes=1)
            rows.append((
                None if rnd.random() < 0.05 else d0 + dt.timedelta(rnd.randint(0, 12)),
                rnd.choice(["a", "b", None]) if rnd.random() < 0.05 else rnd.choice(["a", "b"]),
                rnd.choice(["x", "y"]),
                rnd.choice([None, -3, 0, 5, 9, 12]),
                stamp,
                rnd.choice([None, 0, 1]),
                rnd.choice([None, 0.0, 0.03]),
            ))
        io.write_table(spark.createDataFrame(rows, schema), lake.path("bronze_sales"), "append")
        flows.refresh_silver_incremental(lake, as_of)
        as_of += dt.timedelta(2)
    final_as_of = as_of - dt.timedelta(2)
    full = silver.build_silver(lake.read("bronze_sales"), as_of=F.lit(final_as_of))
    inc = lake.read("silver_sales").select(*full.columns)
    assert inc.count() == full.count()
    assert inc.exceptAll(full).count() == 0 and full.exceptAll(inc).count() == 0


def test_incremental_gold_equals_full_rebuild(spark):
    import random

    from demandlake.operators import gold
    from demandlake.sources import io

    rnd = random.Random(11)
    lake = flows.Lake(spark, storage.scratch_path(spark, "lake_gold_inc"))
    d0 = dt.date(2020, 1, 1)
    schema = ("date date, store string, item string, sales int, ingestion_timestamp timestamp, "
              "is_promo int, discount_pct double")
    stamp = dt.datetime(2020, 1, 1)
    as_of = d0 + dt.timedelta(40)
    for load in range(4):
        rows = []
        # mostly recent days, some late corrections deep in the past
        for _ in range(120 if load == 0 else 25):
            stamp += dt.timedelta(minutes=1)
            back = rnd.randint(0, 40) if load == 0 or rnd.random() < 0.2 else rnd.randint(0, 3)
            rows.append((as_of - dt.timedelta(back), rnd.choice(["a", "b", "c"]), rnd.choice(["x", "y"]),
                         rnd.randint(0, 30), stamp, rnd.choice([0, 1]), rnd.choice([0.0, 0.05])))
        io.write_table(spark.createDataFrame(rows, schema), lake.path("bronze_sales"), "append")
        flows.refresh_silver_incremental(lake, as_of)
        flows.refresh_gold_incremental(lake)
        as_of += dt.timedelta(3)
    full = gold.build_features(lake.read("silver_sales"))
    inc = lake.read("gold_sales_features").select(*full.columns)
    assert inc.count() == full.count() > 0
    assert inc.exceptAll(full).count() == 0 and full.exceptAll(inc).count() == 0
