"""Tables that are replaced, pruned, checked and merged: versions, month
folders, footer statistics, checks while writing, and the load ledger."""

import contextlib
import datetime as dt
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from demandlake import config
from demandlake.functions import columns as C
from demandlake.operators import alerts, checks, gold, registry, slices
from demandlake.plans import catalog, flows
from demandlake.sources import io, schemas, storage
from demandlake.sources.versioned import VersionedTable

SF = "/root/testdata/sf0.001"
DAY = dt.date(2013, 6, 1)
AS_OF = dt.date(2014, 1, 1)
STAMP = dt.datetime(2013, 12, 1, 10, 0)
BRONZE = "date date, store string, item string, sales int, ingestion_timestamp timestamp, is_promo int, discount_pct double"


def load(spark, lake, rows):
    io.write_table(spark.createDataFrame(rows, BRONZE), lake.path("bronze_sales"), "append")


def sale(day, sales, stamp, item="a"):
    return (DAY + dt.timedelta(day), "1", item, sales, stamp, 0, 0.0)


def content(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def rebuilt(spark, lake):
    other = flows.Lake(spark, storage.scratch_path(spark, "rebuilt"))
    io.write_table(lake.read("bronze_sales"), other.path("bronze_sales"), "append")
    flows.refresh_silver(other, F.lit(AS_OF))
    flows.refresh_gold(other)
    return other


def plan(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


# ------------------------------------------------------------- load ledger

def test_late_committed_loads_are_merged(spark):
    lake = flows.Lake(spark, storage.scratch_path(spark, "late"))
    late, equal = STAMP, STAMP + dt.timedelta(minutes=2)
    load(spark, lake, [sale(0, 1, STAMP + dt.timedelta(minutes=2))])
    flows.refresh_silver_incremental(lake, AS_OF)
    flows.refresh_gold_incremental(lake)
    steps = [
        [sale(0, 9, late, "late"), sale(0, 8, late)],  # stamped before the load that is merged already
        [sale(1, 3, equal)],
        [sale(2, 4, None)],
        [],  # an empty load
        [sale(3, 5, dt.datetime(2001, 1, 1))],
    ]
    for rows in steps:
        load(spark, lake, rows)
        flows.refresh_silver_incremental(lake, AS_OF)
        flows.refresh_gold_incremental(lake)
        other = rebuilt(spark, lake)
        assert content(lake.layer("silver_sales")) == content(other.layer("silver_sales"))
        assert content(lake.layer("gold_sales_features")) == content(other.layer("gold_sales_features"))
    items = {r["item"] for r in lake.layer("silver_sales").collect()}
    assert items == {"a", "late"}


def test_a_load_is_merged_once_and_only_new_files_are_read(spark):
    lake = flows.Lake(spark, storage.scratch_path(spark, "ledger"))
    load(spark, lake, [sale(d, d, STAMP) for d in range(3)])
    flows.refresh_silver_incremental(lake, AS_OF)
    load(spark, lake, [sale(9, 9, STAMP)])
    files = flows._files(lake.read("bronze_sales"))
    pending = flows._unmerged(lake, files)
    assert 0 < len(pending) < len(files)
    flows.refresh_silver_incremental(lake, AS_OF)
    assert flows._unmerged(lake, files) == []
    ledger = [r["file"] for r in lake.read("silver_ledger").collect()]
    assert sorted(ledger) == sorted(files)
    flows.refresh_silver_incremental(lake, AS_OF)  # nothing new
    assert lake.layer("silver_sales").count() == 4
    changed = lake.read("silver_changes").filter("refresh_id = 3")
    assert changed.count() == 0


def test_a_refresh_that_broke_off_is_done_again(spark, monkeypatch):
    lake = flows.Lake(spark, storage.scratch_path(spark, "broken"))
    load(spark, lake, [sale(d, d, STAMP) for d in range(3)])
    flows.refresh_silver_incremental(lake, AS_OF)
    load(spark, lake, [sale(1, 50, STAMP + dt.timedelta(1))])

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(flows, "_note_silver", fail)
        with pytest.raises(OSError):
            flows.refresh_silver_incremental(lake, AS_OF)
    flows.refresh_silver_incremental(lake, AS_OF)
    assert content(lake.layer("silver_sales")) == content(rebuilt(spark, lake).layer("silver_sales"))


# ---------------------------------------------------------------- versions

def decisions(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.MODEL_DECISIONS)


def test_table_is_overwritten_from_itself(spark):
    t = VersionedTable(spark, storage.scratch_path(spark, "pointer"), schemas.MODEL_DECISIONS)
    assert t.version == 0 and t.read().count() == 0
    t.replace(decisions(spark, ("BASELINE", "r1", None, STAMP), ("CHALLENGER", "r2", None, STAMP)))
    reader = t.read()
    after = registry.restamp_table(t, F.lit(STAMP + dt.timedelta(1)))
    assert {r["decision_timestamp"] for r in after.collect()} == {STAMP + dt.timedelta(1)}
    assert {r["decision_timestamp"] for r in reader.collect()} == {STAMP}, "an open reader lost its version"
    assert t.version == 2 and after.count() == 2


def test_a_failed_replacement_leaves_the_old_version(spark, monkeypatch):
    t = VersionedTable(spark, storage.scratch_path(spark, "pointer"), schemas.MODEL_DECISIONS)
    t.replace(decisions(spark, ("BASELINE", "r1", None, STAMP)))

    def fail(*_):
        raise OSError("lost before the commit")

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_commit", fail)
        with pytest.raises(OSError):
            t.replace(decisions(spark, ("CHALLENGER", "r2", None, STAMP)))
    assert [r["model_run_id"] for r in t.read().collect()] == ["r1"] and t.version == 1
    bad = t.read().withColumn("model_run_id", F.raise_error(F.lit("broken row")).cast("string"))
    with pytest.raises(Exception, match="broken row"):
        t.replace(bad)
    assert [r["model_run_id"] for r in t.read().collect()] == ["r1"]


def test_alert_table_is_reset_over_old_alerts(spark):
    path = storage.scratch_path(spark, "alerts")
    d = spark.createDataFrame([("is_promo", 0.9), ("sales_lag_7", 0.5)], "feature string, psi double")
    a = alerts.drift_alerts(d, F.lit(STAMP))
    assert alerts.publish_alerts(spark, a, path).count() == 2
    assert alerts.publish_alerts(spark, a, path, keep_history=True).count() == 4
    old = VersionedTable(spark, path, schemas.ALERTS).read()
    assert alerts.publish_alerts(spark, a.filter("feature = 'is_promo'"), path).count() == 1
    empty = alerts.publish_alerts(spark, a.filter("false"), path)
    assert empty.count() == 0 and empty.schema == io.nullable(schemas.ALERTS)
    assert old.count() == 4


# ------------------------------------------------------- windows and plans

def lake_of_months(spark, months=5):
    lake = flows.Lake(spark, storage.scratch_path(spark, "months"))
    load(spark, lake, [sale(d, d % 9, STAMP) for d in range(30 * months)])
    flows.refresh_silver(lake, F.lit(AS_OF))
    flows.refresh_gold(lake)
    return lake


def test_windows_open_their_months_only(spark):
    lake = lake_of_months(spark)
    dated, whole = lake.dated("gold_sales_features"), lake.layer("gold_sales_features")
    for pruned, plain in (
        (slices.since(dated, 30), slices.since(whole, 30)), (slices.before(dated, 90), slices.before(whole, 90)),
        (slices.latest_slice(dated), slices.latest_slice(whole)), *zip(slices.split_holdout(dated), slices.split_holdout(whole), strict=True),
    ):
        assert content(pruned) == content(plain) and pruned.columns == plain.columns
        text = plan(pruned)
        line = next(x for x in text.splitlines() if "PartitionFilters: [isnotnull" in x)
        assert flows.STORAGE_MONTH in line and "Subquery" in line
        assert "PushedAggregation: [MAX(date)]" in text
    recent = slices.latest_slice(dated)
    recent.collect()
    assert recent.inputFiles() and "Location" in plan(recent)


def test_window_at_a_month_border(spark):
    lake = flows.Lake(spark, storage.scratch_path(spark, "border"))
    first = dt.date(2013, 3, 31)  # 30 days before: 1 March; 90 days: 31 December
    days = [dt.date(2012, 12, 30), dt.date(2012, 12, 31), dt.date(2013, 1, 1), dt.date(2013, 2, 28), dt.date(2013, 3, 1), first]
    load(spark, lake, [(d, "1", "a", 1, STAMP, 0, 0.0) for d in days])
    flows.refresh_silver(lake, F.lit(AS_OF))
    t = lake.dated("silver_sales")
    assert {r["date"] for r in slices.since(t, 30).collect()} == set(days[4:])
    train, test = slices.split_holdout(t, 90)
    assert {r["date"] for r in train.collect()} == {days[0]} and {r["date"] for r in test.collect()} == set(days[1:])


@pytest.mark.parametrize("name", ["eval_window", "latest_date_slice", "forecast_mae_rmse", "train_test_counts"])
def test_queries_take_the_maximum_from_footers(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    text = plan(df)
    if name == "eval_window":  # the slice is written once, then read
        assert "Subquery" not in text
    else:
        assert "PushedAggregation: [MAX(date)]" in text
    if name in ("latest_date_slice", "forecast_mae_rmse"):
        assert any(flows.STORAGE_MONTH in x for x in text.splitlines() if "PartitionFilters: [" in x)


@pytest.mark.parametrize(("name", "pushed"), [("max_date", "MAX(date)"), ("date_bounds", "MIN(date), MAX(date)"), ("null_lag_rows", "COUNT(*), COUNT(sales_lag_7)")])
def test_bounds_read_no_rows(spark, name, pushed):
    text = plan(catalog.QUERIES[name](spark, SF))
    assert f"PushedAggregation: [{pushed}]" in text and text.count("Scan") == text.count("BatchScan")


def test_statistics_leave_the_session_as_it_was(spark):
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    path = storage.scratch_path(spark, "t")
    spark.range(5).write.parquet(path)
    io.statistics(spark, path)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    with pytest.raises(Exception, match="(?i)path"):
        io.statistics(spark, path + "-none")
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before


# ------------------------------------------------------------------ guards

def test_empty_window_fails_inside_the_plan(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "sales double, p double")
    ok = slices.required(df.agg(F.count(F.lit(1)).alias("n"), F.avg("p").alias("m")), "n")
    assert ok.collect()[0]["m"] == 2.0
    none = slices.required(df.filter("sales > 9").agg(F.count(F.lit(1)).alias("n"), F.avg("p").alias("m")), "n", "evaluation")
    for read in (none, none.select("m")):  # also if nobody reads the count
        with pytest.raises(Exception, match="evaluation: the selected window has no rows"):
            read.collect()


def test_monitoring_refuses_an_empty_window(spark):
    lake = lake_of_months(spark)  # 28 lags leave complete rows
    flows.train(lake, config.BASELINE)
    flows.train(lake, config.CHALLENGER, forest={"num_trees": 2, "max_depth": 2})
    flows.select_champion(lake)
    assert flows.monitor_performance(lake).count() == 1
    # every later row lacks a lag, so the window has rows but no complete one
    empty = gold.build_features(lake.layer("silver_sales")).withColumn("sales_lag_28", F.lit(None).cast("int"))
    staged = io.materialize(empty, storage.scratch_path(spark, "staged"))
    lake.write_layer(staged, "gold_sales_features")
    for step in (flows.monitor_performance, flows.select_champion):
        with pytest.raises(Exception, match="the selected window has no rows"):
            step(lake)


# ------------------------------------------------------------------ checks

def test_checks_are_taken_while_layers_are_written(spark):
    lake = lake_of_months(spark)
    got = {(r["layer"], r["check"]): r["value"] for r in lake.read("layer_checks").collect()}
    s, g = lake.layer("silver_sales"), lake.layer("gold_sales_features")
    assert got["silver", "row_count"] == str(s.count()) and got["silver", "total_sales"] == str(s.agg(F.sum("sales")).first()[0])
    assert got["gold", "rows_with_null_lag"] == str(g.filter("sales_lag_7 IS NULL").count()) == "7"
    assert got["gold", "max_date"] == str(g.agg(F.max("date")).first()[0])
    rows, taken = checks.observed(s.filter("false").select("date", "is_promo", "sales"), "silver")
    rows.write.format("noop").mode("overwrite").save()
    assert taken.get == {"row_count": 0, "promo_rows": None, "total_sales": None}


# ------------------------------------------------- names, scratch, casting

def test_lake_tables_by_name(spark):
    lake = lake_of_months(spark, months=2)
    for _ in range(2):  # entering a table again renews it
        lake.register(["silver_sales", "layer_checks"], "by_name_")
        assert spark.sql("SELECT count(*) FROM by_name_silver_sales WHERE storage_month = '2013-06'").first()[0] == 30
        assert spark.table("by_name_layer_checks").count() == lake.read("layer_checks").count()
    load(spark, lake, [sale(70, 1, STAMP)])
    flows.refresh_silver_incremental(lake, AS_OF)
    lake.register(["silver_sales"], "by_name_")
    assert spark.sql("SELECT count(*) FROM by_name_silver_sales").first()[0] == 61


def test_scratch_lies_in_one_folder_that_is_deleted(spark):
    root = storage.scratch_root(spark)
    assert storage.scratch_path(spark, "x").startswith(root + "/x-") and spark.sparkContext.applicationId in root
    assert storage.exists(spark, root) and not storage.exists(spark, root + "/none")


def test_fingerprint_follows_the_files(spark):
    path = storage.scratch_path(spark, "prints")
    spark.range(5).write.parquet(path)
    one = storage.fingerprint(spark, path)
    assert storage.fingerprint(spark, path) == one
    spark.range(5).write.mode("append").parquet(path)
    assert storage.fingerprint(spark, path) != one


def test_profile_counts_values_and_distinct_ones(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, None)], "x int, y string")
    assert [tuple(r) for r in schemas.profile(df).collect()] == [(0, "x", "int", 4, 3, 2), (1, "y", "string", 4, 2, 2)]
    assert [tuple(r)[3:] for r in schemas.profile(df.filter("x > 9")).collect()] == [(0, 0, 0), (0, 0, 0)]


NUMBERS = ["13.7", "-2.5", ".9", "-.9", ".", "+.", "+", "-", "", " ", "5.", "13.99999999999", "-13.99999999999999999999", "2147483647.9", "2147483648.0",
           "-2147483648.99", "-2147483649.", "1.2.3", "1e3", "\t8.1\n", " 7 ", " 7.5 ", "7 .5", "0x1", "1_0", "x", "٣.5", None, "00012.3", "9" * 40 + ".1"]


def agrees(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["v"] for r in df.select(C.lenient_int("t").alias("v")).collect()]
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        want = [r["v"] for r in df.selectExpr("CAST(t AS INT) AS v").collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert got == want, [(t, g, w) for t, g, w in zip(texts, got, want, strict=True) if g != w]


def test_lenient_int_equals_the_cast_without_ansi(spark):
    agrees(spark, NUMBERS)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="0123456789+-. \t\x00e", max_size=14), min_size=50, max_size=80))
def test_lenient_int_on_any_text(spark, texts):
    agrees(spark, texts)


def test_tables_by_name_builds_silver_once(spark, monkeypatch):
    """Three writes share one written silver, instead of joining and ranking all lines three times."""
    from demandlake.plans import catalog

    built, written = [], []
    silver, save = catalog._silver, catalog.io.save_named
    monkeypatch.setattr(catalog, "_silver", lambda *a: built.append(1) or silver(*a))
    monkeypatch.setattr(catalog.io, "save_named", lambda df, *a: written.append(df._jdf.queryExecution().executedPlan().toString()) or save(df, *a))
    assert catalog.tables_by_name(spark, "/root/testdata/sf0.001").count() > 0
    assert len(built) == 1 and len(written) == 2 and not any("Join" in plan or "Window" in plan for plan in written)


def test_layers_are_written_in_shares_of_their_input(spark, monkeypatch):
    """Shuffle partitions follow the input's files while a layer is written,
    and the session's settings come back, also after a failure."""
    parts, share = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    first = spark.conf.get(parts), spark.conf.get(share)
    path = storage.scratch_path(spark, "shares of input")
    spark.range(20000).select(F.date_add(F.lit(dt.date(2013, 1, 1)), (F.col("id") % 60).cast("int")).alias("date"), "id").repartition(3).write.partitionBy("date").parquet(path)
    df = spark.read.parquet(path)
    size = sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path.removeprefix("file:")) for f in names if f.endswith(".parquet"))
    assert size and storage.bytes_of(spark, df.inputFiles()) == size
    monkeypatch.setattr(io, "INPUT_SHARE", 1000)
    seen = []
    noted = io.dealt_by_size

    @contextlib.contextmanager
    def note(rows):
        with noted(rows):
            seen.append((int(spark.conf.get(parts)), int(spark.conf.get(share))))
            yield

    monkeypatch.setattr(io, "dealt_by_size", note)
    lake = flows.Lake(spark, storage.scratch_path(spark, "shares"))
    lake.write_layer(df, "by_share")
    assert lake.read("by_share").count() == 20000
    assert seen == [(-(-size // 1000), io.SHUFFLE_SHARE)] and seen[0][0] > int(first[0])
    with pytest.raises(ZeroDivisionError), noted(spark.range(3)):
        assert spark.conf.get(parts) == first[0]  # no files: as many as the session has
        1 / 0
    assert (spark.conf.get(parts), spark.conf.get(share)) == first
