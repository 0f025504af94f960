import datetime as dt

from pyspark.sql import functions as F

from demandlake.functions import columns as C
from demandlake.operators import bronze
from demandlake.sources import io, schemas, storage


def test_lenient_typing(spark):
    raw = spark.createDataFrame(
        [("bad", "x", "a", "1"), ("2013-1-2", "13.7", "b", "2"), ("2013-01-03", "7", "c", "3")],
        "date string, sales string, store string, item string",
    )
    rows = {r["store"]: (r["date"], r["sales"]) for r in bronze.type_sales(raw).collect()}
    assert rows["a"] == (None, None)
    assert rows["b"] == (dt.date(2013, 1, 2), 13)
    assert rows["c"] == (dt.date(2013, 1, 3), 7)


def test_date_shift_over_leap_years(spark):
    df = spark.createDataFrame([(dt.date(2013, 1, 1),)], "date date")
    assert bronze.shift_dates(df).first()["date"] == dt.date(2018, 12, 31)


def test_promo_bucket_edges(spark):
    df = spark.createDataFrame([(0,), (9,), (10,), (99,)], "b long")
    out = df.select("b", C.promo_flag("b").alias("f")).select("b", "f", C.promo_discount("b", "f").alias("d"))
    got = {r["b"]: (r["f"], round(r["d"], 12)) for r in out.collect()}
    assert got == {0: (1, 0.0), 9: (1, 0.027), 10: (0, 0.0), 99: (0, 0.0)}


def test_hash_bucket_is_deterministic_and_in_range(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("store"), F.lit("i").alias("item"),
                                  F.date_add(F.lit(dt.date(2020, 1, 1)), F.col("id").cast("int")).alias("date"))
    a = bronze.promo_bucket(df, ("store", "item", "date"), "b").select("b").collect()
    b = bronze.promo_bucket(df, ("store", "item", "date"), "b").select("b").collect()
    assert a == b
    assert all(0 <= r["b"] < 100 for r in a)


def test_hash_bucket_int_min_does_not_overflow(spark):
    # abs() on a BIGINT cast: the INT_MIN hash must not raise under ANSI mode.
    df = spark.createDataFrame([(-2147483648,)], "h int")
    assert df.select((F.abs(F.col("h").cast("long")) % 100).alias("b")).first()["b"] == 48


def test_required_csv_columns(spark, tmp_path):
    p = str(tmp_path / "raw.csv")
    with open(p, "w") as fh:
        fh.write("date,store,sales\n2013-01-01,1,3\n")
    try:
        io.read_raw_sales(spark, p)
        raise AssertionError("missing column not detected")
    except ValueError as e:
        assert "item" in str(e)


def test_csv_reads_all_strings(spark, tmp_path):
    p = str(tmp_path / "raw.csv")
    with open(p, "w") as fh:
        fh.write("date,store,item,sales,extra\n2013-01-01,1,2,3,z\n")
    df = io.read_raw_sales(spark, p)
    assert {f.dataType.simpleString() for f in df.schema.fields} == {"string"}
    assert df.columns == ["date", "store", "item", "sales", "extra"]


def test_schema_evolution_append(spark):
    path = storage.scratch_path(spark, "evolve")
    raw = spark.createDataFrame([("2013-01-01", "1", "2", "3")], "date string, store string, item string, sales string")
    io.write_table(bronze.ingest(raw, with_promo=False), path, "append")
    io.write_table(bronze.ingest(raw, with_promo=True), path, "append", evolve=True)
    back = io.read_back(spark, path, merge_schema=True)
    assert set(back.columns) >= {"is_promo", "discount_pct", "ingestion_timestamp"}
    assert back.filter(F.col("is_promo").isNull()).count() == 1
    assert back.count() == 2


def test_conform_rejects_null_in_non_nullable(spark):
    df = spark.createDataFrame([(None, 1.0, 1.0, 0.0, "OK", dt.datetime(2020, 1, 1))],
                               "active_model string, baseline_mae double, active_model_mae double, "
                               "degradation_pct double, status string, evaluation_timestamp timestamp")
    try:
        schemas.conform(df, schemas.PERFORMANCE).collect()
        raise AssertionError("NULL accepted")
    except Exception as e:  # noqa: BLE001
        assert "non-nullable" in str(e)


def test_describe(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert [tuple(r) for r in schemas.describe(df).collect()] == [(0, "x", "int"), (1, "y", "string")]
