"""DuckDB SQL that fits the models again: OLS by elimination on centred sums,
the forest level by level from the same cuts and draws, scored by a recursive
walk over the node table.  Each step is one materialised CTE."""

from __future__ import annotations

from demandlake import config
from demandlake.operators import forest
from demandlake.plans import oracle as O
from demandlake.plans import params as P
from demandlake.plans.model_catalog import CHALLENGER, FOREST

BINS = forest.Settings().max_bins


def _with(ctes: list[tuple[str, str]], final: str) -> str:
    body = ",\n".join(f"{name} AS {'' if '(' in name else 'MATERIALIZED '}({sql}\n)" for name, sql in ctes)
    return f"WITH RECURSIVE {body}\n{final}"


_COMPLETE = f"{O.NOT_NULL_FEATS} AND sales IS NOT NULL"
TRAIN = [*O.BASE, ("train_m", f"SELECT * FROM ({O.TRAIN}) t WHERE {_COMPLETE}")]
TEST = ("test_m", f"SELECT * FROM ({O.TEST}) t WHERE {_COMPLETE}")
RECENT = ("recent_m", f"SELECT * FROM ({O.EVAL}) t WHERE {_COMPLETE}")
LATEST = ("latest_m", f"SELECT * FROM gold WHERE date = {O.MAX_DATE} AND {O.NOT_NULL_FEATS}")


# ------------------------------------------------------------------- OLS

def _gram() -> str:
    terms = {"intercept": "CAST(1 AS DOUBLE)", **{f: f"CAST({f} AS DOUBLE)" for f in [*config.FEATURES, config.TARGET]}}
    names = list(terms)
    cells = [f"{{'i': '{a}', 'j': '{b}', 's': sum({terms[a]} * {terms[b]})}}" for k, a in enumerate(names) for b in names[k:]]
    return f"""
  SELECT c.i AS term_i, c.j AS term_j, n AS n_rows, round(c.s / n, 6) AS mean_product
  FROM (SELECT count(*) AS n, unnest([{', '.join(cells)}]) AS c FROM train_m)"""


def ols_ctes() -> list[tuple[str, str]]:
    """``coef(intercept, b)``: Gauss-Jordan on the centred normal equations."""
    feats, n = config.FEATURES, len(config.FEATURES)
    means = ", ".join(f"avg(CAST({f} AS DOUBLE)) AS m{i}" for i, f in enumerate([*feats, config.TARGET]))
    centred = [f"(CAST({f} AS DOUBLE) - m{i})" for i, f in enumerate([*feats, config.TARGET])]
    rows = ", ".join("[" + ", ".join(f"sum({centred[i]} * {centred[j]})" for j in range(n + 1)) + "]" for i in range(n))
    step = (
        f"list_transform(range({n}), lambda i: CASE WHEN i = k THEN list_transform(m[k + 1], lambda x: x / m[k + 1][k + 1]) "
        f"ELSE list_transform(range({n + 1}), lambda j: m[i + 1][j + 1] - m[i + 1][k + 1] / m[k + 1][k + 1] * m[k + 1][j + 1]) END)"
    )
    slopes = ", ".join(f"m[{i + 1}][{n + 1}]" for i in range(n))
    fitted = " - ".join(f"m[{i + 1}][{n + 1}] * m{i}" for i in range(n))
    return [
        ("means", f"SELECT {means} FROM train_m"),
        ("centred", f"SELECT [{rows}] AS m FROM train_m, means"),
        ("elim(k, m)", f"SELECT 0, m FROM centred UNION ALL SELECT k + 1, {step} FROM elim WHERE k < {n}"),
        ("coef", f"SELECT m{n} - {fitted} AS intercept, [{slopes}] AS b FROM elim, means WHERE k = {n}"),
    ]


def _ols_score() -> str:
    return " + ".join(["intercept", *(f"b[{i + 1}] * CAST({f} AS DOUBLE)" for i, f in enumerate(config.FEATURES))])


def _metrics(role: str, scored: str) -> str:
    return f"""
  SELECT '{role}' AS model_role, count(*) AS n_rows, round(avg(abs(CAST(sales AS DOUBLE) - p)), 6) AS mae,
         round(sqrt(avg((CAST(sales AS DOUBLE) - p) * (CAST(sales AS DOUBLE) - p))), 6) AS rmse
  FROM ({scored})"""


# ---------------------------------------------------------------- forest

def forest_ctes(num_trees: int, max_depth: int, seed: int) -> list[tuple[str, str]]:
    """``f_nodes``: the node table fitted on ``train_m``."""
    keys = [(O._days("date"), "int"), ("store", "str"), ("item", "str"), (str(seed), "int")]  # config.KEYS, then the seed
    hashed, last, _ = O.hash_ctes("f_src", keys, "f")
    feats = config.FEATURES
    long = " UNION ALL ".join(f"SELECT rid, {i} AS f, CAST({f} AS DOUBLE) AS x FROM f_rows" for i, f in enumerate(feats))
    steps = " + ".join(f"CASE WHEN u >= {s} THEN 1 ELSE 0 END" for s in forest.poisson_steps())
    ctes = [
        ("f_src", "SELECT row_number() OVER () AS rid, * FROM train_m"),
        *hashed,
        ("f_rows", f"SELECT *, __fh & {O.M32} AS h, CAST(sales AS DOUBLE) AS y FROM {last}"),
        ("f_long", long),
        ("f_span", f"SELECT f, min(x) AS lo, (max(x) - min(x)) / {forest.GRID} AS step, count(*) AS n FROM f_long GROUP BY f HAVING max(x) > min(x)"),
        ("f_cell", f"""
  SELECT f, lo, step, n, least(floor((x - lo) / step), {forest.GRID - 1}) AS cell, count(*) AS c
  FROM f_long JOIN f_span USING (f) GROUP BY ALL"""),
        ("f_rank", f"SELECT *, floor(CAST(sum(c) OVER (PARTITION BY f ORDER BY cell) - c AS BIGINT) * {BINS} / n) AS q FROM f_cell"),
        ("f_cut", """
  SELECT f, row_number() OVER (PARTITION BY f ORDER BY cell) - 1 AS k, lo + cell * step AS cut
  FROM (SELECT *, lag(q) OVER (PARTITION BY f ORDER BY cell) AS last_q FROM f_rank) WHERE q > last_q"""),
        ("f_bin", "SELECT l.rid, l.f, count(c.k) AS bin FROM f_long l LEFT JOIN f_cut c ON l.f = c.f AND l.x >= c.cut GROUP BY l.rid, l.f"),
        ("f_draw", f"SELECT rid, y, t, {O._round('h', 't')} AS p FROM f_rows, range({num_trees}) r(t)"),
        ("f_unit", f"SELECT rid, y, t, {O._fmix('p', '4')} AS u FROM f_draw"),
        ("f_a0", f"SELECT rid, y, t, w, 1::BIGINT AS node FROM (SELECT rid, y, t, CAST({steps} AS DOUBLE) AS w FROM f_unit) WHERE w > 0"),
    ]
    for d in range(max_depth):
        ctes += [
            (f"f_h{d}", f"SELECT a.t, a.node, b.f, b.bin, sum(a.w) AS w, sum(a.w * a.y) AS s FROM f_a{d} a JOIN f_bin b USING (rid) GROUP BY ALL"),
            (f"f_c{d}", f"""
  SELECT t, node, f, bin, sum(w) OVER c AS lw, sum(s) OVER c AS ls, sum(w) OVER n AS tw, sum(s) OVER n AS ts FROM f_h{d}
  WINDOW c AS (PARTITION BY t, node, f ORDER BY bin), n AS (PARTITION BY t, node, f)"""),
            (f"f_b{d}", f"""
  SELECT * FROM (
    SELECT *, ls * ls / lw + (ts - ls) * (ts - ls) / (tw - lw) - ts * ts / tw AS gain FROM f_c{d} WHERE tw > lw
    QUALIFY row_number() OVER (PARTITION BY t, node ORDER BY gain DESC, f, bin) = 1)
  WHERE gain > ts * ts / tw * {forest.LEAST_GAIN!r} AND gain > 0"""),
            (f"f_a{d + 1}", f"""
  SELECT a.rid, a.y, a.t, a.w, a.node * 2 + CASE WHEN b.bin > s.bin THEN 1 ELSE 0 END AS node
  FROM f_a{d} a JOIN f_b{d} s USING (t, node) JOIN f_bin b ON b.rid = a.rid AND b.f = s.f"""),
        ]
    children = " UNION ALL ".join(
        f"SELECT t, node * 2 AS node, lw AS weight, ls / lw AS value FROM f_b{d} "
        f"UNION ALL SELECT t, node * 2 + 1, tw - lw, (ts - ls) / (tw - lw) FROM f_b{d}" for d in range(max_depth)
    )
    inner = " UNION ALL ".join(f"SELECT t, node, f, bin FROM f_b{d}" for d in range(max_depth))
    names = "CASE i.f " + " ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(feats)) + " END"
    return [
        *ctes,
        ("f_value", f"SELECT t, 1::BIGINT AS node, sum(w) AS weight, sum(w * y) / sum(w) AS value FROM f_a0 GROUP BY t UNION ALL {children}"),
        ("f_inner", inner),
        ("f_nodes", f"""
  SELECT CAST(v.t AS INTEGER) AS tree, v.node, {names} AS feature, c.cut, CASE WHEN i.f IS NOT NULL THEN v.node * 2 END AS "left",
         CASE WHEN i.f IS NOT NULL THEN v.node * 2 + 1 END AS "right", v.value, v.weight
  FROM f_value v LEFT JOIN f_inner i ON v.t = i.t AND v.node = i.node LEFT JOIN f_cut c ON c.f = i.f AND c.k = i.bin"""),
    ]


def walk_ctes(src: str, keep: str) -> list[tuple[str, str]]:
    """``w_score``: ``src`` rows with p, the mean of the leaves reached."""
    value = "CASE n.feature " + " ".join(f"WHEN '{f}' THEN CAST(s.{f} AS DOUBLE)" for f in config.FEATURES) + " END"
    return [
        ("w_rows", f"SELECT row_number() OVER () AS rid, * FROM {src}"),
        ("walk(rid, tree, node)", f"""
  SELECT rid, CAST(t AS INTEGER), 1::BIGINT FROM w_rows, range({FOREST['num_trees']}) r(t)
  UNION ALL
  SELECT k.rid, k.tree, CASE WHEN {value} >= n.cut THEN n."right" ELSE n."left" END
  FROM walk k JOIN f_nodes n ON k.tree = n.tree AND k.node = n.node JOIN w_rows s ON s.rid = k.rid WHERE n.cut IS NOT NULL"""),
        ("w_mean", """
  SELECT k.rid, avg(n.value) AS p FROM walk k JOIN f_nodes n ON k.tree = n.tree AND k.node = n.node WHERE n.cut IS NULL GROUP BY k.rid"""),
        ("w_score", f"SELECT {keep}, p FROM w_rows JOIN w_mean USING (rid)"),
    ]


def _oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    ols, grown = ols_ctes(), forest_ctes(**FOREST)
    keys = ", ".join(config.KEYS)
    q["gram_matrix"] = _with(TRAIN, _gram())
    values = {"intercept": "intercept", **{f: f"b[{i + 1}]" for i, f in enumerate(config.FEATURES)}}
    terms = ", ".join(f"{{'term': '{t}', 'coefficient': round({v}, 6)}}" for t, v in values.items())
    q["ols_coefficients"] = _with([*TRAIN, *ols], f"SELECT c.term, c.coefficient FROM (SELECT unnest([{terms}]) AS c FROM coef)")
    base = _metrics(config.BASELINE, f"SELECT sales, {_ols_score()} AS p FROM test_m, coef")
    q["holdout_metrics"] = _with([*TRAIN, TEST, *ols], base)
    q["forest_nodes"] = _with([*TRAIN, *forest_ctes(**CHALLENGER)], "SELECT * FROM f_nodes")
    q["stump_means"] = _with(TRAIN, "SELECT CAST(is_promo AS INTEGER) AS is_promo, count(*) AS n_rows, round(avg(sales), 6) AS mean_sales FROM train_m GROUP BY is_promo")
    challenger = _metrics(config.CHALLENGER, "SELECT sales, p FROM w_score")
    q["forest_holdout_metrics"] = _with([*TRAIN, TEST, *grown, *walk_ctes("test_m", "sales")], challenger)
    q["fitted_model_comparison"] = _with(
        [*TRAIN, RECENT, *ols, *grown, *walk_ctes("recent_m", f"sales, {O.FEATS}")],
        f"SELECT round(avg(abs(CAST(sales AS DOUBLE) - ({_ols_score()}))), 6) AS baseline_mae, round(avg(abs(CAST(sales AS DOUBLE) - p)), 6) AS challenger_mae FROM w_score, coef",
    )
    q["forest_forecast"] = _with(
        [*TRAIN, LATEST, *grown, *walk_ctes("latest_m", keys)],
        f"SELECT {keys}, round(p, 6) AS predicted_sales, '{config.CHALLENGER}' AS model_role, true AS run_is_newest, {O._ts(P.EVAL_TS)} AS prediction_timestamp FROM w_score",
    )
    row = "SELECT model_role, '{kind}' AS model_type, '{env}' AS env, '{feats}' AS features, mae, rmse FROM ({m})"
    q["run_metrics"] = _with(
        [*TRAIN, TEST, *ols, *grown, *walk_ctes("test_m", "sales")],
        row.format(kind="LinearRegression", env=P.ENV, feats=",".join(config.FEATURES), m=base) + "\n  UNION ALL "
        + row.format(kind="RandomForestRegressor", env=P.ENV, feats=",".join(config.FEATURES), m=challenger),
    )
    return q


MODEL_ORACLES: dict[str, str] = _oracles()
