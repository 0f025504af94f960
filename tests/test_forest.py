"""The forest against a plain recursive version, on any layout, saved and
loaded, and at its edges."""

import math

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from demandlake.operators import forest, models
from demandlake.sources import storage

FEATURES = ["x", "z", "one"]


def rows(spark, n=400, parts=4):
    return spark.range(n).select(
        "id", (F.col("id") % 7).cast("double").alias("x"), (F.col("id") * 13 % 29 / 4).alias("z"), F.lit(1.0).alias("one"),
        (F.col("id") % 7 * 3 + F.col("id") * 13 % 29 % 5).cast("double").alias("sales"),
    ).repartition(parts)


def grow(df, partitions=None, **settings):
    s = forest.Settings(**{"num_trees": 5, "max_depth": 4, **settings})
    return forest.grow(df, FEATURES, "sales", ["id"], s, partitions)


def by_hand(pdf, cuts, settings):
    """Node table by plain recursion over the rows of each node."""
    x, y, h = pdf[FEATURES].to_numpy(float), pdf["sales"].to_numpy(float), pdf["h"].to_numpy(np.int32).view(np.uint32)
    out = []

    def split(tree, node, at, w, depth):
        weight, total = w[at].sum(), (w[at] * y[at]).sum()
        best = (0.0, None, None)
        if depth < settings.max_depth:
            own = total * total / weight
            best = (max(0.0, own * forest.LEAST_GAIN), None, None)
            for f in range(len(FEATURES)):
                for c in cuts[f]:
                    left, right = at[x[at, f] < c], at[x[at, f] >= c]
                    lw, rw = w[left].sum(), w[right].sum()
                    if lw and rw:
                        ls, rs = (w[left] * y[left]).sum(), (w[right] * y[right]).sum()
                        gain = ls * ls / lw + rs * rs / rw - own
                        if gain > best[0]:
                            best = (gain, f, c)
        _, f, c = best
        out.append((tree, node, FEATURES[f] if f is not None else None, c, 2 * node if c is not None else None, 2 * node + 1 if c is not None else None, total / weight, weight))
        if c is not None:
            split(tree, 2 * node, at[x[at, f] < c], w, depth + 1)
            split(tree, 2 * node + 1, at[x[at, f] >= c], w, depth + 1)

    for t in range(settings.num_trees):
        w = forest.tree_weight(h, t, settings.bootstrap)
        split(t, 1, np.flatnonzero(w), w, 0)
    return sorted(out, key=lambda r: r[:2])


@pytest.mark.parametrize("bootstrap", [True, False])
def test_forest_equals_plain_recursion(spark, bootstrap):
    df = rows(spark)
    settings = forest.Settings(num_trees=4, max_depth=4, max_bins=16, bootstrap=bootstrap)
    got = forest.grow(df, FEATURES, "sales", ["id"], settings)
    cuts = forest.cut_points(df, FEATURES, settings.max_bins)
    assert cuts[2] == [] and len(cuts[0]) == 6 and all(c == sorted(c) and len(c) < 16 for c in cuts)
    pdf = df.withColumn("h", F.hash("id", F.lit(settings.seed))).toPandas()
    assert got.table == by_hand(pdf, cuts, settings)


def test_layout_and_passes_do_not_change_the_forest(spark, monkeypatch):
    one = grow(rows(spark, parts=4)).table
    assert grow(rows(spark, parts=64)).table == one
    assert grow(rows(spark, parts=3).orderBy(F.rand(1)), partitions=1).table == one
    monkeypatch.setattr(forest, "PASS_BYTES", 1)  # a pass for each tree
    assert grow(rows(spark, parts=5)).table == one


def test_predictions_at_4_and_64_partitions(spark):
    sums = []
    for parts in (4, 64):
        m = models.feature_matrix(rows(spark, parts=parts), ["x", "z"], keep=["id"])
        model = models.fit_challenger(m, num_trees=5, max_depth=4, row_key=["id"])
        sums.append(sorted((r["id"], r["prediction"]) for r in model.transform(m).collect()))
    assert sums[0] == sums[1]


def test_scores_walk_the_saved_table(spark):
    df = rows(spark)
    model = grow(df)
    path = storage.scratch_path(spark, "forest_model")
    models.save_model(spark, model, path)
    loaded = models.load_model(models.FOREST, path)
    assert loaded.table == model.table and loaded.features == model.features and loaded.num_trees == 5
    nodes = {(r[0], r[1]): r for r in loaded.table}

    def score(row):
        total = 0.0
        for t in range(5):
            n = nodes[t, 1]
            while n[2] is not None:
                n = nodes[t, n[5] if row[n[2]] >= n[3] else n[4]]
            total += n[6]
        return total / 5

    for r in loaded.transform(df).collect():
        assert r["prediction"] == score(r)


def test_draws_are_poisson_and_sparks_hash(spark):
    got = spark.range(3000).select(F.hash("id", F.lit(42)).alias("h"), F.hash("id", F.lit(42), F.lit(7)).alias("u")).toPandas()
    draw = forest.tree_draw(got["h"].to_numpy(np.int32).view(np.uint32), 7)
    assert draw.tolist() == got["u"].to_numpy(np.int32).view(np.uint32).tolist()
    h = np.arange(200000, dtype=np.uint32) * np.uint32(2654435761)
    w = forest.tree_weight(h, 3)
    for k in range(5):
        assert abs((w == k).mean() - math.exp(-1) / math.factorial(k)) < 0.005


def test_edges(spark):
    with pytest.raises(RuntimeError, match="no complete row"):
        grow(rows(spark, n=0))
    single = grow(rows(spark, n=1), num_trees=40)  # some trees draw no row
    assert {r[6] for r in single.table} == {0.0} and len(single.table) == 40
    flat = grow(rows(spark).withColumn("sales", F.lit(3.0)))
    assert [r[2] for r in flat.table] == [None] * 5  # nothing to gain
    with pytest.raises(ValueError, match="max_bins"):
        grow(rows(spark), max_bins=300)
    repeated = grow(rows(spark).unionByName(rows(spark)))  # equal keys, equal draws
    assert [r[:6] for r in repeated.table] == [r[:6] for r in grow(rows(spark)).table]


def test_gram_rows_are_the_products(spark):
    df = rows(spark)
    pdf = df.toPandas()
    m = np.column_stack([np.ones(len(pdf)), pdf[["x", "z", "sales"]]])
    names = ["intercept", "x", "z", "sales"]
    got = {(r["term_i"], r["term_j"]): r["total"] for r in models.gram_rows(df, ["x", "z"], "sales").collect()}
    assert len(got) == 10
    for i, a in enumerate(names):
        for j in range(i, 4):
            assert abs(got[a, names[j]] - m[:, i] @ m[:, j]) < 1e-6


def packed_rows(x, y, h, size):
    """Record batches of ``size`` rows as the passes read them."""
    for i in range(0, len(x), size):
        bins = pa.array([r.tobytes() for r in x[i : i + size]], pa.binary())
        yield pa.RecordBatch.from_arrays([bins, pa.array(y[i : i + size]), pa.array(h[i : i + size].view(np.int32))], ["bins", "y", "h"])


@pytest.mark.parametrize("labels", ["whole", "parts", "below zero", "large"])
@pytest.mark.parametrize("level", [0, 3, 6])
def test_sums_of_a_pass_equal_plain_ones(labels, level):
    r = np.random.default_rng(level)
    n, f, bins, depth = 3000, 3, 8, 7
    x, h = r.integers(0, bins, (n, f)).astype(np.uint8), r.integers(0, 2**32, n).astype(np.uint32)
    y = r.integers(0, 50, n).astype(float)
    y = {"whole": y, "parts": y / 8, "below zero": y - 20, "large": y * 2**40}[labels]
    trees = {t: forest._Tree(depth) for t in (0, 2)}
    for t, tree in trees.items():
        tree.feature[1 : 1 << depth], tree.bin[1 : 1 << depth] = r.integers(0, f, (1 << depth) - 1), r.integers(0, bins - 1, (1 << depth) - 1)
        tree.feature[[2 + t // 2, 11]] = -1  # leaves above the level
    want, at = {}, {t: np.ones(n, int) for t in trees}
    for t, tree in trees.items():
        for _ in range(level):
            at[t] = np.where(tree.feature[at[t]] < 0, 0, 2 * at[t] + (x[np.arange(n), tree.feature[at[t]]] > tree.bin[at[t]]))
        w = forest.tree_weight(h, t)
        for node in np.unique(at[t][(at[t] > 0) & (w > 0)]):
            use = at[t] == node
            want[t, int(node)] = np.array([[np.bincount(x[use, i], v[use], bins) for i in range(f)] for v in (w, w * y)])
    active = {t: np.array([k for s, k in want if s == t]) for t in trees}
    out = [row for b in forest._sums(trees, active, level, f, bins, True)(packed_rows(x, y, h, 700)) for row in b.to_pylist()]
    assert {(o["tree"], o["node"]) for o in out} == set(want)
    assert all((np.frombuffer(o["sums"]).reshape(2, f, bins) == want[o["tree"], o["node"]]).all() for o in out)


def test_work_of_a_pass_does_not_follow_the_batches(monkeypatch):
    """Small batches are added up together: the sums of a pass are gone
    through once for all of them, not once for each."""
    n = 2000
    x, y, h = np.zeros((n, 2), np.uint8), np.ones(n), np.arange(n, dtype=np.uint32)
    counted, count = [], np.bincount
    monkeypatch.setattr(forest.np, "bincount", lambda *a: counted.append(1) or count(*a))
    trees = {t: forest._Tree(2) for t in range(3)}
    list(forest._sums(trees, {t: np.array([1]) for t in trees}, 0, 2, 8, True)(packed_rows(x, y, h, 10)))
    assert len(counted) == 3 * 2  # before: two for each of 200 batches and each tree


def test_weights_by_table_equal_the_steps():
    steps = np.array(forest.poisson_steps(), np.uint64)
    edge = np.concatenate([steps - np.uint64(1), steps, steps + np.uint64(1)]).astype(np.uint32)
    h = np.concatenate([edge, np.random.default_rng(1).integers(0, 2**32, 20000).astype(np.uint32)])
    draw = forest.tree_draw(h, 5)
    assert (forest.tree_weight(h, 5) == np.searchsorted(steps, draw.astype(np.uint64), side="right")).all()
    forest_draw = forest.tree_draw
    try:
        forest.tree_draw = lambda rows, tree: rows  # the thresholds themselves as draws
        assert (forest.tree_weight(h, 5) == np.searchsorted(steps, h.astype(np.uint64), side="right")).all()
    finally:
        forest.tree_draw = forest_draw


def test_a_value_that_is_not_a_number_goes_left(spark):
    table = [(0, 1, "x", 2.0, 2, 3, 0.0, 4.0), (0, 2, None, None, None, None, -1.0, 2.0), (0, 3, None, None, None, None, 1.0, 2.0)]
    df = spark.createDataFrame([(None,), (float("nan"),), (1.9,), (2.0,), (float("inf"),)], "x double")
    got = forest.Forest(table, ["x"]).transform(df)
    assert [r["prediction"] for r in got.collect()] == [-1.0, -1.0, -1.0, 1.0, 1.0]


def test_forest_nodes_is_the_whole_challenger(spark, tmp_path):
    """100 trees of depth 10, node for node what its SQL fits on rows of its own."""
    con = duckdb.connect()
    line = """SELECT i AS l_orderkey, i % 12 AS l_partkey, i % 12 AS l_suppkey, CAST(1 + i % 2 AS INTEGER) AS l_linenumber,
        CAST(1 + hash(i) % 50 AS DOUBLE) AS l_quantity, hash(i * 7) % 11 / 100 AS l_discount, 'N' AS l_returnflag,
        TIMESTAMP '2000-01-01' + to_days(CAST(i // 12 AS INTEGER)) AS l_shipdate FROM range(3600) r(i)"""
    for name, sql in {
        "lineitem": line, "orders": "SELECT i AS o_orderkey, TIMESTAMP '1999-01-01' AS o_orderdate FROM range(3600) r(i)",
        "supplier": "SELECT i AS s_suppkey FROM range(12) r(i)", "part": "SELECT i AS p_partkey, 'type' || i AS p_type FROM range(12) r(i)",
    }.items():
        con.execute(f"COPY ({sql}) TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    got = queries()["forest_nodes"](spark, str(tmp_path)).orderBy("tree", "node").collect()
    assert {r["tree"] for r in got} == set(range(100)) and max(r["node"] for r in got) >= 1 << 10  # before: 6 trees, nodes up to 15
    assert [tuple(r) for r in got] == con.execute(f"SELECT * FROM ({oracle_sql()['forest_nodes']}) ORDER BY tree, node").fetchall()
