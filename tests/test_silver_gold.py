import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from demandlake.operators import gold, silver

D = dt.date(2020, 1, 1)
T1 = dt.datetime(2020, 1, 2)
T2 = dt.datetime(2020, 1, 3)
BRONZE = ("date date, store string, item string, sales int, ingestion_timestamp timestamp, "
          "is_promo int, discount_pct double")


def _bronze(spark, rows):
    return spark.createDataFrame(rows, BRONZE)


def test_clamp_and_defaults(spark):
    rows = [(D + dt.timedelta(i), "s", "i", v, T1, None, None) for i, v in enumerate([None, -5, 0, 7])]
    out = silver.clean(_bronze(spark, rows), as_of=F.lit(D + dt.timedelta(10))).orderBy("date").collect()
    assert [r["sales"] for r in out] == [0, 0, 0, 7]
    assert {r["is_promo"] for r in out} == {0} and {r["discount_pct"] for r in out} == {0.0}


def test_future_dates_and_null_keys(spark):
    as_of = D
    rows = [
        (D + dt.timedelta(1), "s", "i", 1, T1, 0, 0.0),
        (D + dt.timedelta(2), "s", "i", 1, T1, 0, 0.0),
        (D, None, "i", 1, T1, 0, 0.0),
        (D, "s", None, 1, T1, 0, 0.0),
        (None, "s", "i", 1, T1, 0, 0.0),
    ]
    out = silver.clean(_bronze(spark, rows), as_of=F.lit(as_of)).collect()
    assert [r["date"] for r in out] == [D + dt.timedelta(1)]


def test_newest_version_wins_even_when_dirty(spark):
    rows = [(D, "s", "i", 10, T1, 1, 0.1), (D, "s", "i", None, T2, None, None)]
    out = silver.build_silver(_bronze(spark, rows), as_of=F.lit(D)).collect()
    assert len(out) == 1 and out[0]["sales"] == 0 and out[0]["is_promo"] == 0


def test_invalid_newer_row_does_not_hide_valid_one(spark):
    rows = [(D, "s", "i", 10, T1, 1, 0.1), (D + dt.timedelta(30), "s", "i", 3, T2, 0, 0.0)]
    out = silver.build_silver(_bronze(spark, rows), as_of=F.lit(D)).collect()
    assert [(r["date"], r["sales"]) for r in out] == [(D, 10)]


def test_two_loads_dedup_keeps_promo_rows(spark):
    from demandlake.operators import bronze as b
    old = _bronze(spark, [(D, "s", "i", 5, T1, None, None)]).drop("is_promo", "discount_pct")
    new = _bronze(spark, [(D, "s", "i", 5, T2, 1, 0.03)])
    out = silver.build_silver(b.evolve_union(old, new), as_of=F.lit(D)).collect()
    assert len(out) == 1 and out[0]["is_promo"] == 1 and out[0]["ingestion_timestamp"] == T2


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from("ab"), st.integers(0, 5), st.integers(-3, 20)),
                min_size=1, max_size=40))
def test_dedup_one_row_per_key(spark, rows):
    data = [(D + dt.timedelta(d), s, "i", v, T1 + dt.timedelta(hours=h), 0, 0.0) for d, s, h, v in rows]
    out = silver.build_silver(_bronze(spark, data), as_of=F.lit(D + dt.timedelta(10)),
                              tie_breakers=[F.col("sales").desc()]).collect()
    keys = {(r["date"], r["store"]) for r in out}
    assert len(keys) == len(out) == len({(D + dt.timedelta(d), s) for d, s, _, _ in rows})
    for r in out:
        cands = [(h, max(v, 0)) for d, s, h, v in rows if (D + dt.timedelta(d), s) == (r["date"], r["store"])]
        assert (r["ingestion_timestamp"] - T1).seconds // 3600 == max(h for h, _ in cands)
        assert r["sales"] == max(v for h, v in cands if h == max(h2 for h2, _ in cands))


def test_calendar(spark):
    df = spark.createDataFrame([(dt.date(2023, 1, 1),)], "date date")
    r = gold.calendar_features(df).first()
    assert (r["day_of_week"], r["week_of_year"], r["month"]) == (1, 52, 1)


def _series(spark, dates, sales):
    rows = [(d, "s", "i", v) for d, v in zip(dates, sales)]
    return spark.createDataFrame(rows, "date date, store string, item string, sales int")


def test_lag_counts_rows_not_days(spark):
    dates = [D + dt.timedelta(i) for i in range(10) if i != 4]
    out = gold.lag_features(_series(spark, dates, list(range(1, 10)))).orderBy("date").collect()
    assert out[7]["sales_lag_7"] == 1 and out[8]["sales_lag_7"] == 2
    assert all(r["sales_lag_7"] is None for r in out[:7])


def test_rolling_start(spark):
    sales = list(range(1, 10))
    out = gold.rolling_means(_series(spark, [D + dt.timedelta(i) for i in range(9)], sales)).orderBy("date").collect()
    m7 = [r["sales_roll_mean_7"] for r in out]
    assert m7[0] is None and m7[1] == 1.0
    assert m7[7] == sum(sales[0:7]) / 7 and m7[8] == sum(sales[1:8]) / 7


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=60))
def test_features_equal_python_loop(spark, sales):
    dates = [D + dt.timedelta(2 * i) for i in range(len(sales))]
    out = gold.build_features(
        _series(spark, dates, sales).withColumns({"is_promo": F.lit(0), "discount_pct": F.lit(0.0)})
    ).orderBy("date").collect()
    for i, r in enumerate(out):
        for k in (7, 14, 28):
            assert r[f"sales_lag_{k}"] == (sales[i - k] if i >= k else None)
        for k in (7, 28):
            prev = sales[max(0, i - k):i]
            want = sum(prev) / len(prev) if prev else None
            got = r[f"sales_roll_mean_{k}"]
            assert (got is None and want is None) or abs(got - want) < 1e-12
