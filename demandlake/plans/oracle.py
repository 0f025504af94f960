"""DuckDB SQL equivalents of the registered queries (the correctness
oracle).  Each entry is one statement over the driver's tables
(``lineitem orders supplier nation part events`` ...), composed from the
shared CTEs below.  Column names and types follow the Spark side.
"""

from __future__ import annotations

from demandlake import config
from demandlake.plans import params as P

M32 = "4294967295"

# ------------------------------------------------------------ fixtures

SALES_FACTS = """
  SELECT CAST(l_shipdate AS DATE) AS date,
         CAST(l_suppkey AS VARCHAR) AS store,
         p_type AS item,
         CAST(SUM(l_quantity) AS INTEGER) AS sales
  FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN part ON l_partkey = p_partkey
  GROUP BY CAST(l_shipdate AS DATE), CAST(l_suppkey AS VARCHAR), p_type"""

BRONZE_DIRTY = """
  SELECT CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS date,
         CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE CAST(l_suppkey AS VARCHAR) END AS store,
         CASE WHEN l_orderkey % 83 = 0 THEN NULL ELSE p_type END AS item,
         CASE WHEN l_orderkey % 71 = 0 THEN NULL
              WHEN l_returnflag = 'R' AND l_linenumber % 2 = 0 THEN -CAST(l_quantity AS INTEGER)
              ELSE CAST(l_quantity AS INTEGER) END AS sales,
         o_orderdate AS ingestion_timestamp,
         CASE WHEN l_linenumber % 3 = 0 THEN NULL
              WHEN l_discount > 0.08 THEN 1 ELSE 0 END AS is_promo,
         CASE WHEN l_linenumber % 3 = 0 THEN NULL
              WHEN l_discount > 0.08 THEN l_discount * 0.3 ELSE CAST(0 AS DOUBLE) END AS discount_pct,
         l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN part ON l_partkey = p_partkey"""

RAW_STRINGS = """
  SELECT CASE WHEN l_orderkey % 97 = 0 THEN 'not-a-date'
              ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS date,
         CAST(l_suppkey AS VARCHAR) AS store,
         CAST(l_partkey AS VARCHAR) AS item,
         CASE WHEN l_orderkey % 89 = 0 THEN 'x'
              WHEN l_orderkey % 5 = 0 THEN CONCAT(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), '.99999999999')
              ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS sales
  FROM lineitem"""

INT_KEYS = """
  SELECT l_orderkey, l_linenumber,
         CAST(l_suppkey AS INTEGER) AS store,
         CAST(l_partkey AS INTEGER) AS item,
         CAST(l_shipdate AS DATE) AS date
  FROM lineitem"""

MODEL_RUNS = """
  SELECT CONCAT('run_', CAST(o_orderkey AS VARCHAR)) AS run_id,
         o_orderdate AS start_time,
         CASE WHEN o_custkey % 2 = 0 THEN 'DEV' ELSE 'PROD' END AS env,
         CASE WHEN o_orderkey % 2 = 0 THEN 'BASELINE' ELSE 'CHALLENGER' END AS model_role,
         o_totalprice / 1000 AS mae
  FROM orders"""

MODEL_DECISIONS = """
  SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'BASELINE' ELSE 'CHALLENGER' END AS active_model,
         CONCAT('run_', CAST(o_orderkey AS VARCHAR)) AS model_run_id,
         CAST(NULL AS VARCHAR) AS reason,
         o_orderdate AS decision_timestamp
  FROM orders"""

DRIFT_BATCHES = """
  SELECT CASE event_type WHEN 'view' THEN 'is_promo' WHEN 'click' THEN 'discount_pct'
              WHEN 'purchase' THEN 'sales_lag_7' WHEN 'signup' THEN 'sales_lag_28'
              ELSE 'sales_roll_mean_7' END AS feature,
         MAX(value) / 1000 AS psi,
         CAST(CAST(ts AS DATE) AS TIMESTAMP) AS evaluation_timestamp
  FROM events
  GROUP BY event_type, CAST(ts AS DATE)"""

_TIE = (
    "ingestion_timestamp DESC NULLS LAST, l_orderkey DESC NULLS LAST, l_linenumber DESC NULLS LAST, "
    "l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, sales DESC NULLS LAST, "
    "is_promo DESC NULLS LAST, discount_pct DESC NULLS LAST"
)

CLEAN = f"""
  SELECT date, store, item,
         CASE WHEN sales IS NULL OR sales < 0 THEN 0 ELSE sales END AS sales,
         ingestion_timestamp,
         COALESCE(is_promo, 0) AS is_promo,
         COALESCE(discount_pct, CAST(0 AS DOUBLE)) AS discount_pct,
         l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM bronze_dirty
  WHERE date IS NOT NULL AND date <= DATE '{P.AS_OF}' + 1
    AND store IS NOT NULL AND item IS NOT NULL"""

SILVER = f"""
  SELECT * FROM clean
  QUALIFY row_number() OVER (PARTITION BY date, store, item ORDER BY {_TIE}) = 1"""


def _calendar_cols() -> str:
    return """CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week,
         CAST(weekofyear(date) AS INTEGER) AS week_of_year,
         CAST(month(date) AS INTEGER) AS month"""


_W = "PARTITION BY store, item ORDER BY date"


def _lag_cols() -> str:
    return ",\n         ".join(f"lag(sales, {k}) OVER ({_W}) AS sales_lag_{k}" for k in config.LAGS)


def _roll_cols() -> str:
    return ",\n         ".join(
        f"avg(sales) OVER ({_W} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) AS sales_roll_mean_{k}"
        for k in config.ROLLING
    )


def gold_from(src: str) -> str:
    return f"""
  SELECT date, store, item, sales, is_promo, discount_pct,
         {_calendar_cols()},
         {_lag_cols()},
         {_roll_cols()}
  FROM {src}"""


def with_(ctes: list[tuple[str, str]], final: str) -> str:
    body = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in ctes)
    return f"WITH {body}\n{final}"


BASE = [("bronze_dirty", BRONZE_DIRTY), ("clean", CLEAN), ("silver", SILVER), ("gold", gold_from("silver"))]

# ------------------------------------------------- Murmur3 (Spark hash)


def _mul(a: str, c: int) -> str:
    return f"((({a})::HUGEINT * {c}) % 4294967296)::BIGINT"


def _rotl(a: str, r: int) -> str:
    return f"(((({a}) << {r}) | (({a}) >> {32 - r})) & {M32})"


def _round(h: str, k: str) -> str:
    k1 = _mul(_rotl(_mul(k, 0xCC9E2D51), 15), 0x1B873593)
    h1 = f"xor({h}, {k1})"
    return f"(({_rotl(h1, 13)} * 5 + {0xE6546B64}) & {M32})"


def _fmix(h: str, n: str) -> str:
    h = f"xor({h}, {n})"
    h = f"xor({h}, ({h}) >> 16)"
    h = _mul(h, 0x85EBCA6B)
    h = f"xor({h}, ({h}) >> 13)"
    h = _mul(h, 0xC2B2AE35)
    return f"xor({h}, ({h}) >> 16)"


def _str_words(s: str) -> str:
    word = " + ".join(f"ascii(substr({s}, 4 * i + {b + 1}, 1)) * {256 ** b}" for b in range(4))
    return (
        f"list_concat(list_transform(range(strlen({s}) // 4), lambda i: {word}), "
        f"list_transform(range(4 * (strlen({s}) // 4), strlen({s})), lambda j: ascii(substr({s}, j + 1, 1))))"
    )


def hash_ctes(src: str, keys: list[tuple[str, str]], prefix: str) -> tuple[list[tuple[str, str]], str, list[str]]:
    """CTEs computing Spark's ``hash(k1, k2, ...)`` (Murmur3 x86 32, seed 42,
    chained left to right, NULL keys skipped); returns (ctes, last CTE name,
    helper columns).  The final hash is in column ``__{prefix}h`` (signed)."""
    ctes = []
    helpers = []
    prev_tab, prev_h = src, "42"
    for i, (expr, kind) in enumerate(keys):
        p, h = f"__{prefix}p{i}", f"__{prefix}h{i}"
        helpers += [p, h]
        if kind == "str":
            pre = f"list_reduce(list_concat([{prev_h}::BIGINT], {_str_words(expr)}), lambda h, k: {_round('h', 'k')})"
            n = f"strlen({expr})"
        else:
            pre = _round(prev_h, f"(({expr})::BIGINT & {M32})")
            n = "4"
        ctes.append((f"{prefix}s{i}a", f"SELECT *, {pre} AS {p}, {n} AS {p}n FROM {prev_tab}"))
        helpers.append(f"{p}n")
        ctes.append(
            (f"{prefix}s{i}b",
             f"SELECT *, CASE WHEN ({expr}) IS NULL THEN {prev_h} ELSE {_fmix(p, p + 'n')} END AS {h} FROM {prefix}s{i}a")
        )
        prev_tab, prev_h = f"{prefix}s{i}b", h
    signed = f"__{prefix}h"
    helpers.append(signed)
    ctes.append(
        (f"{prefix}hashed",
         f"SELECT *, CASE WHEN {prev_h} >= 2147483648 THEN {prev_h} - 4294967296 ELSE {prev_h} END AS {signed} FROM {prev_tab}")
    )
    return ctes, f"{prefix}hashed", helpers


def _days(expr: str) -> str:
    return f"({expr} - DATE '1970-01-01')"


def _bucket(hcol: str) -> str:
    return f"(abs({hcol}) % 100)"


def _promo_cols(b: str) -> str:
    return (
        f"CASE WHEN {b} < 10 THEN 1 ELSE 0 END AS is_promo, "
        f"CASE WHEN {b} < 10 THEN (CAST({b} AS DOUBLE) / 100.0) * 0.3 ELSE CAST(0 AS DOUBLE) END AS discount_pct"
    )


def _excl(helpers: list[str]) -> str:
    return f"EXCLUDE ({', '.join(helpers)})"


# ------------------------------------------------------------ helpers


def _ts(v: str) -> str:
    return f"TIMESTAMP '{v}'"


def _lin(coef: dict, intercept: float) -> str:
    expr = f"CAST({float(intercept)!r} AS DOUBLE)"
    for name, c in coef.items():
        expr = f"({expr} + CAST({float(c)!r} AS DOUBLE) * CAST({name} AS DOUBLE))"
    return expr


FEATS = ", ".join(config.FEATURES)
GOLD_COLS = ", ".join(config.GOLD_COLUMNS)
NOT_NULL_FEATS = " AND ".join(f"{f} IS NOT NULL" for f in config.FEATURES)
NOT_NULL_GOLD = " AND ".join(f"{f} IS NOT NULL" for f in config.GOLD_COLUMNS)
NOT_NULL_DRIFT = " AND ".join(f"{f} IS NOT NULL" for f in config.DRIFT_FEATURES)

MAX_DATE = "(SELECT max(date) FROM gold)"
TRAIN = f"SELECT * FROM gold WHERE date < {MAX_DATE} - 90"
TEST = f"SELECT * FROM gold WHERE date >= {MAX_DATE} - 90"
EVAL = f"SELECT * FROM gold WHERE date >= {MAX_DATE} - 30"
COMPLETE = f"date, store, item, sales, {FEATS}"

EVAL_MAES = f"""
  SELECT avg(abs(CAST(sales AS DOUBLE) - {_lin(P.BASELINE_COEF, P.BASELINE_INTERCEPT)})) AS baseline_mae,
         avg(abs(CAST(sales AS DOUBLE) - {_lin(P.CHALLENGER_COEF, P.CHALLENGER_INTERCEPT)})) AS challenger_mae
  FROM ({EVAL}) e WHERE {NOT_NULL_FEATS} AND sales IS NOT NULL"""

DEV_PER_ROLE = """
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY model_role ORDER BY start_time DESC, run_id DESC) AS rn
    FROM model_runs WHERE env = 'DEV') WHERE rn = 1"""

ROLE_PIVOT = """
  SELECT max(CASE WHEN model_role = 'BASELINE' THEN run_id END) AS baseline_run_id,
         max(CASE WHEN model_role = 'BASELINE' THEN mae END) AS baseline_mae,
         max(CASE WHEN model_role = 'CHALLENGER' THEN run_id END) AS challenger_run_id,
         max(CASE WHEN model_role = 'CHALLENGER' THEN mae END) AS challenger_mae
  FROM per_role"""

CHAMPION = """
  SELECT CASE WHEN m.challenger_mae < m.baseline_mae * (1 - 0.05) THEN 'CHALLENGER' ELSE 'BASELINE' END AS active_model,
         CASE WHEN m.challenger_mae < m.baseline_mae * (1 - 0.05) THEN p.challenger_run_id ELSE p.baseline_run_id END AS model_run_id,
         m.baseline_mae, m.challenger_mae
  FROM eval_maes m, role_piv p"""

ACTIVE = """
  SELECT * FROM model_decisions ORDER BY decision_timestamp DESC, model_run_id DESC LIMIT 1"""

ACTIVE_MAES = """
  SELECT a.active_model, m.baseline_mae,
         CASE WHEN a.active_model = 'CHALLENGER' THEN m.challenger_mae ELSE m.baseline_mae END AS active_model_mae
  FROM eval_maes m, active a"""

SEVERE = """
  SELECT evaluation_timestamp,
         COALESCE(bool_or(psi > 0.25 AND feature IN ('is_promo', 'discount_pct')), false) AS severe_drift
  FROM drift_batches GROUP BY evaluation_timestamp"""

ROLLBACK = """
  SELECT s.evaluation_timestamp, s.severe_drift, p.baseline_run_id, p.baseline_mae, p.challenger_mae,
         COALESCE(s.severe_drift AND p.challenger_mae > p.baseline_mae * 1.05, false) AS rollback_required
  FROM severe s, role_piv p"""

LATEST_BATCH = "SELECT * FROM drift_batches WHERE evaluation_timestamp = (SELECT max(evaluation_timestamp) FROM drift_batches)"

ALERTS = f"""
  SELECT feature, CAST(psi AS DOUBLE) AS metric_value,
         CASE WHEN feature IN ('is_promo', 'discount_pct') THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
         'DRIFT' AS alert_type, {_ts(P.EVAL_TS)} AS alert_timestamp
  FROM latest_batch WHERE psi > 0.25"""


def _psi_ctes() -> list[tuple[str, str]]:
    feats = config.DRIFT_FEATURES
    unpivot = " UNION ALL ".join(
        f"SELECT side, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM sides" for f in feats
    )
    edge_i = " + ".join(
        f"CASE WHEN l.value >= e.lo + {i} * e.width THEN 1 ELSE 0 END" for i in range(1, config.PSI_BINS)
    )
    return [
        ("sides", f"""
  SELECT CASE WHEN date < {MAX_DATE} - 90 THEN 'ref' WHEN date >= {MAX_DATE} - 30 THEN 'cur' END AS side,
         {', '.join(feats)}
  FROM gold
  WHERE (date < {MAX_DATE} - 90 OR date >= {MAX_DATE} - 30) AND {NOT_NULL_DRIFT}"""),
        ("longf", unpivot),
        ("raw_edges", "SELECT feature, min(value) AS lo, max(value) AS hi FROM longf WHERE side = 'ref' GROUP BY feature"),
        ("edges", f"""
  SELECT feature,
         CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo,
         CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi,
         ((CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END) - (CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END)) / {float(config.PSI_BINS)!r} AS width
  FROM raw_edges"""),
        ("binned", f"""
  SELECT l.feature, l.side,
         CASE WHEN l.value >= e.lo AND l.value <= e.hi THEN 0 + {edge_i} END AS bin
  FROM longf l JOIN edges e ON l.feature = e.feature"""),
        ("totals", """
  SELECT feature, count(*) FILTER (WHERE side = 'ref') AS ref_total, count(*) FILTER (WHERE side = 'cur') AS cur_total
  FROM binned GROUP BY feature"""),
        ("counts", """
  SELECT feature, bin, count(*) FILTER (WHERE side = 'ref') AS n_ref, count(*) FILTER (WHERE side = 'cur') AS n_cur
  FROM binned WHERE bin IS NOT NULL GROUP BY feature, bin"""),
        ("hist", f"""
  SELECT g.feature, CAST(g.bin AS INTEGER) AS bin,
         COALESCE(c.n_ref, 0) AS n_ref, COALESCE(c.n_cur, 0) AS n_cur,
         CASE WHEN t.ref_total > 0 THEN CAST(COALESCE(c.n_ref, 0) AS DOUBLE) / t.ref_total END AS ref_share,
         CASE WHEN t.cur_total > 0 THEN CAST(COALESCE(c.n_cur, 0) AS DOUBLE) / t.cur_total END AS cur_share
  FROM (SELECT e.feature, b.bin FROM edges e, range({config.PSI_BINS}) b(bin)) g
  LEFT JOIN counts c ON g.feature = c.feature AND g.bin = c.bin
  LEFT JOIN totals t ON g.feature = t.feature"""),
        ("psi", f"""
  SELECT feature,
         CASE WHEN count(*) FILTER (WHERE ref_share IS NULL OR cur_share IS NULL) > 0 THEN NULL
              ELSE sum((ref_share - cur_share) * ln((ref_share + {config.PSI_EPSILON!r}) / (cur_share + {config.PSI_EPSILON!r}))) END AS psi
  FROM hist GROUP BY feature"""),
    ]


def _oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    facts = [("sales_facts", SALES_FACTS)]
    q["csv_scan"] = with_(facts, "SELECT CAST(date AS VARCHAR) AS date, store, item, CAST(sales AS VARCHAR) AS sales FROM sales_facts")
    q["table_scan"] = "SELECT * FROM orders"
    q["append_readback"] = with_(facts, "SELECT * FROM sales_facts UNION ALL SELECT * FROM sales_facts")
    q["overwrite_readback"] = with_(facts, "SELECT * FROM sales_facts")

    raw = [("raw", RAW_STRINGS)]
    # DuckDB rounds decimal text; the lenient cast cuts it at the point
    typed = "SELECT TRY_CAST(date AS DATE) AS date, store, item, TRY_CAST(split_part(sales, '.', 1) AS INTEGER) AS sales FROM raw"
    q["raw_typed"] = with_(raw, typed)
    shifted = "SELECT date + 2190 AS date, store, item, sales FROM typed"
    q["date_shifted"] = with_(raw + [("typed", typed)], shifted)
    q["ingest_stamped"] = with_(
        raw + [("typed", typed), ("shifted", shifted)], f"SELECT *, {_ts(P.LOAD_TS)} AS ingestion_timestamp FROM shifted"
    )

    # bronze with two loads (second one carries hash promo columns)
    hc, last, helpers = hash_ctes("load2_src", [("store", "str"), ("item", "str"), (_days("date"), "int")], "b")
    load2_src = f"SELECT *, {_ts(P.LOAD_TS_2)} AS ingestion_timestamp FROM shifted"
    load2 = f"SELECT * {_excl(helpers)}, {_promo_cols(_bucket('__bh'))} FROM {last}"
    two = raw + [("typed", typed), ("shifted", shifted), ("load2_src", load2_src)] + hc + [("load2", load2)]
    evolved = (
        f"SELECT *, CAST(NULL AS INTEGER) AS is_promo, CAST(NULL AS DOUBLE) AS discount_pct FROM "
        f"(SELECT *, {_ts(P.LOAD_TS)} AS ingestion_timestamp FROM shifted) "
        f"UNION ALL BY NAME SELECT * FROM load2"
    )
    q["bronze_evolved"] = with_(two, evolved)
    desc = [
        (0, "date", "date"), (1, "store", "string"), (2, "item", "string"), (3, "sales", "int"),
        (4, "ingestion_timestamp", "timestamp_ntz"), (5, "is_promo", "int"), (6, "discount_pct", "double"),
    ]
    q["schema_description"] = with_(
        two + [("evolved", evolved)],
        " UNION ALL ".join(
            f"SELECT CAST({i} AS INTEGER) AS col_pos, '{n}' AS col_name, '{t}' AS data_type, count(*) AS n_rows, count({n}) AS n_values, "
            f"count(DISTINCT {n}) AS n_distinct FROM evolved" for i, n, t in desc
        ),
    )

    ik = [("ik", INT_KEYS)]
    hc, last, helpers = hash_ctes("ik", [("store", "int"), ("item", "int"), (_days("date"), "int")], "p")
    q["promo_bucket"] = with_(ik + hc, f"SELECT * {_excl(helpers)}, {_bucket('__ph')} AS bucket FROM {last}")
    q["promo_assigned"] = with_(ik + hc, f"SELECT * {_excl(helpers)}, {_promo_cols(_bucket('__ph'))} FROM {last}")
    q["promo_summary"] = with_(
        ik + hc + [("promo", f"SELECT {_promo_cols(_bucket('__ph'))} FROM {last}")],
        "SELECT count(*) AS total_rows, CAST(sum(is_promo) AS BIGINT) AS promo_rows FROM promo",
    )

    dirty = [("bronze_dirty", BRONZE_DIRTY)]
    q["clean_sales"] = with_(dirty, CLEAN)
    q["silver_latest"] = with_(dirty + [("clean", CLEAN)], SILVER)
    silver = dirty + [("clean", CLEAN), ("silver", SILVER)]
    q["calendar_features"] = with_(silver, f"SELECT *, {_calendar_cols()} FROM silver")
    q["lag_features"] = with_(silver, f"SELECT *, {_lag_cols()} FROM silver")
    q["rolling_means"] = with_(silver, f"SELECT *, {_roll_cols()} FROM silver")
    q["gold_features"] = with_(silver, gold_from("silver"))

    hc, last, helpers = hash_ctes("fstamped", [("store", "str"), ("item", "str"), (_days("date"), "int")], "g")
    fchain = facts + [("fstamped", f"SELECT *, {_ts(P.LOAD_TS)} AS ingestion_timestamp FROM sales_facts")] + hc + [
        ("fbronze", f"SELECT * {_excl(helpers)}, {_promo_cols(_bucket('__gh'))} FROM {last}"),
        ("fclean", f"""
  SELECT date, store, item, CASE WHEN sales IS NULL OR sales < 0 THEN 0 ELSE sales END AS sales,
         ingestion_timestamp, COALESCE(is_promo, 0) AS is_promo, COALESCE(discount_pct, CAST(0 AS DOUBLE)) AS discount_pct
  FROM fbronze WHERE date IS NOT NULL AND date <= DATE '{P.AS_OF}' + 1 AND store IS NOT NULL AND item IS NOT NULL"""),
        ("fsilver", """
  SELECT * FROM fclean QUALIFY row_number() OVER (PARTITION BY date, store, item ORDER BY ingestion_timestamp DESC) = 1"""),
    ]
    q["gold_projection"] = with_(fchain, gold_from("fsilver"))

    g = BASE
    q["train_test_counts"] = with_(
        g, f"SELECT count(*) FILTER (WHERE date < {MAX_DATE} - 90) AS train_rows, "
           f"count(*) FILTER (WHERE date >= {MAX_DATE} - 90) AS test_rows FROM gold"
    )
    q["eval_window"] = with_(g, f"SELECT {GOLD_COLS} FROM ({EVAL}) e WHERE {NOT_NULL_GOLD}")
    q["latest_date_slice"] = with_(g, f"SELECT * FROM gold WHERE date = {MAX_DATE}")
    drift = [("drift_batches", DRIFT_BATCHES)]
    q["latest_batch_slice"] = with_(drift, LATEST_BATCH)
    q["complete_rows"] = with_(g, f"SELECT {FEATS}, sales FROM gold WHERE {NOT_NULL_FEATS} AND sales IS NOT NULL")
    q["date_bounds"] = with_(g, "SELECT min(date) AS min_date, max(date) AS max_date FROM gold")
    q["ts_bounds"] = with_(dirty, "SELECT min(ingestion_timestamp) AS min_ts, max(ingestion_timestamp) AS max_ts FROM bronze_dirty")
    q["silver_totals"] = with_(silver, "SELECT CAST(sum(is_promo) AS BIGINT) AS promo_rows, CAST(sum(sales) AS BIGINT) AS total_sales FROM silver")
    dec = [("model_decisions", MODEL_DECISIONS)]
    q["model_versions"] = with_(dec, "SELECT count(*) AS decision_rows, count(DISTINCT model_run_id) AS model_versions FROM model_decisions")
    q["null_lag_rows"] = with_(g, "SELECT count(*) FILTER (WHERE sales_lag_7 IS NULL) AS rows_with_null_lag FROM gold")
    q["max_date"] = with_(g, "SELECT max(date) AS max_date FROM gold")
    q["layer_checks"] = with_(g, """
  SELECT 'bronze' AS layer, "check", value FROM (
    SELECT CAST(count(*) AS VARCHAR) AS row_count, CAST(min(date) AS VARCHAR) AS min_date,
           CAST(max(date) AS VARCHAR) AS max_date, CAST(sum(is_promo) AS VARCHAR) AS promo_rows FROM bronze_dirty)
    UNPIVOT (value FOR "check" IN (row_count, min_date, max_date, promo_rows))
  UNION ALL
  SELECT 'silver' AS layer, "check", value FROM (
    SELECT CAST(count(*) AS VARCHAR) AS row_count, CAST(sum(is_promo) AS VARCHAR) AS promo_rows,
           CAST(sum(sales) AS VARCHAR) AS total_sales FROM silver)
    UNPIVOT (value FOR "check" IN (row_count, promo_rows, total_sales))
  UNION ALL
  SELECT 'gold' AS layer, "check", value FROM (
    SELECT CAST(count(*) AS VARCHAR) AS row_count,
           CAST(count(*) FILTER (WHERE sales_lag_7 IS NULL) AS VARCHAR) AS rows_with_null_lag,
           CAST(min(date) AS VARCHAR) AS min_date, CAST(max(date) AS VARCHAR) AS max_date FROM gold)
    UNPIVOT (value FOR "check" IN (row_count, rows_with_null_lag, min_date, max_date))""")

    q["tables_by_name"] = with_(silver, """
  SELECT strftime(date, '%Y-%m') AS storage_month, CAST(sum(sales) AS BIGINT) AS total_sales, CAST(sum(is_promo) AS BIGINT) AS promo_rows
  FROM silver GROUP BY 1""")

    base_lin = _lin(P.BASELINE_COEF, P.BASELINE_INTERCEPT)
    q["fixed_linear_scores"] = with_(g, f"""
  SELECT date, store, item, {FEATS},
         {base_lin} AS predicted_sales,
         '{P.FIXED_BASELINE_RUN}' AS model_run_id, 'BASELINE' AS model_role, {_ts(P.EVAL_TS)} AS prediction_timestamp
  FROM gold WHERE date = {MAX_DATE} AND {NOT_NULL_FEATS}""")
    chal_lin = _lin(P.CHALLENGER_COEF, P.CHALLENGER_INTERCEPT)
    q["forecast_checks"] = with_(g + [
        ("latest", f"SELECT * FROM gold WHERE date = {MAX_DATE} AND {NOT_NULL_FEATS}"),
        ("fc", f"""
  SELECT {base_lin} AS predicted_sales, '{P.FIXED_BASELINE_RUN}' AS model_run_id, {_ts(P.EVAL_TS)} AS prediction_timestamp FROM latest
  UNION ALL
  SELECT {chal_lin} AS predicted_sales, '{P.FIXED_CHALLENGER_RUN}' AS model_run_id, {_ts(P.EVAL_TS_2)} AS prediction_timestamp FROM latest"""),
    ], """
  SELECT count(*) AS forecast_rows, count(DISTINCT model_run_id) AS model_versions,
         min(prediction_timestamp) AS min_prediction_timestamp, max(prediction_timestamp) AS max_prediction_timestamp
  FROM fc""")
    q["forecast_mae_rmse"] = with_(g, f"""
  SELECT count(*) AS n_rows,
         round(avg(abs(CAST(sales AS DOUBLE) - p)), 6) AS mae,
         round(sqrt(avg((CAST(sales AS DOUBLE) - p) * (CAST(sales AS DOUBLE) - p))), 6) AS rmse
  FROM (SELECT sales, {base_lin} AS p FROM ({TEST}) t WHERE {NOT_NULL_FEATS} AND sales IS NOT NULL)""")
    stats = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, count(*) AS n_rows, round(sum(CAST({f} AS DOUBLE)), 6) AS col_sum, "
        f"CAST(min({f}) AS DOUBLE) AS col_min, CAST(max({f}) AS DOUBLE) AS col_max FROM train_m"
        for f in config.FEATURES
    )
    train_m = f"SELECT * FROM ({TRAIN}) t WHERE {NOT_NULL_FEATS} AND sales IS NOT NULL"
    q["feature_matrix_stats"] = with_(g + [("train_m", train_m)], stats)
    terms = ", ".join(f"('{t}')" for t in ["intercept", *config.FEATURES])
    q["ols_normal_equations"] = with_(
        g + [("train_m", train_m)],
        f"SELECT v.term, (SELECT count(*) FROM train_m) AS n_rows, true AS orthogonal FROM (VALUES {terms}) v(term)",
    )
    q["forest_invariants"] = with_(
        g + [("train_m", train_m)],
        "SELECT count(*) AS n_rows, true AS within_label_range, true AS beats_mean_predictor FROM train_m",
    )
    q["model_comparison"] = with_(
        g + [("eval_maes", EVAL_MAES)], "SELECT round(baseline_mae, 6) AS baseline_mae, round(challenger_mae, 6) AS challenger_mae FROM eval_maes"
    )

    psi = g + _psi_ctes()
    q["feature_histogram"] = with_(psi, "SELECT * FROM hist")
    q["feature_psi"] = with_(psi, "SELECT feature, round(psi, 6) AS psi FROM psi")
    q["drift_metrics"] = with_(psi, f"SELECT feature, round(psi, 6) AS psi, {_ts(P.EVAL_TS)} AS evaluation_timestamp FROM psi")
    lb = drift + [("latest_batch", LATEST_BATCH)]
    q["drift_alerts"] = with_(lb, ALERTS)
    q["alerts_published"] = with_(lb, ALERTS)
    q["severe_drift"] = with_(drift, SEVERE)
    test_m = f"SELECT * FROM ({TEST}) t WHERE {NOT_NULL_FEATS} AND sales IS NOT NULL"
    q["run_roundtrip"] = with_(
        g + [("test_m", test_m)],
        "SELECT 'LinearRegression' AS model_type, count(*) AS n_rows, CAST(0 AS DOUBLE) AS max_abs_diff FROM test_m",
    )

    runs = [("model_runs", MODEL_RUNS)]
    q["latest_run"] = with_(runs, "SELECT * FROM model_runs ORDER BY start_time DESC, run_id DESC LIMIT 1")
    q["latest_run_per_role"] = with_(runs, DEV_PER_ROLE)
    q["active_model"] = with_(dec, ACTIVE)
    q["active_run_lookup"] = with_(
        dec + runs + [("active", ACTIVE)],
        "SELECT a.*, r.start_time, r.env, r.model_role, r.mae FROM active a LEFT JOIN model_runs r ON a.model_run_id = r.run_id",
    )
    q["decision_history"] = with_(dec, "SELECT * FROM model_decisions ORDER BY decision_timestamp DESC")
    champ = g + runs + [("eval_maes", EVAL_MAES), ("per_role", DEV_PER_ROLE), ("role_piv", ROLE_PIVOT), ("champ", CHAMPION)]
    q["champion_decision"] = with_(
        champ, "SELECT active_model, model_run_id, round(baseline_mae, 6) AS baseline_mae, round(challenger_mae, 6) AS challenger_mae FROM champ"
    )
    q["decision_written"] = with_(
        champ + dec,
        f"SELECT * FROM model_decisions UNION ALL SELECT active_model, model_run_id, CAST(NULL AS VARCHAR) AS reason, "
        f"{_ts(P.EVAL_TS)} AS decision_timestamp FROM champ",
    )
    am = g + dec + [("eval_maes", EVAL_MAES), ("active", ACTIVE), ("am", ACTIVE_MAES)]
    q["degradation_status"] = with_(am, """
  SELECT active_model, round(baseline_mae, 6) AS baseline_mae, round(active_model_mae, 6) AS active_model_mae,
         round(CASE WHEN baseline_mae <> 0 THEN (active_model_mae - baseline_mae) / baseline_mae END, 6) AS degradation_pct,
         CASE WHEN baseline_mae = 0 AND active_model_mae > 0 THEN 'DEGRADED'
              WHEN baseline_mae <> 0 AND (active_model_mae - baseline_mae) / baseline_mae > 1.05 - 1 THEN 'DEGRADED'
              ELSE 'OK' END AS status
  FROM am""")
    q["performance_row"] = with_(am, f"""
  SELECT active_model, round(baseline_mae, 6) AS baseline_mae, round(active_model_mae, 6) AS active_model_mae,
         round(CASE WHEN baseline_mae <> 0 THEN (active_model_mae - baseline_mae) / baseline_mae
                    WHEN active_model_mae > 0 THEN 'inf'::DOUBLE ELSE 0.0 END, 6) AS degradation_pct,
         CASE WHEN baseline_mae = 0 AND active_model_mae > 0 THEN 'DEGRADED'
              WHEN baseline_mae <> 0 AND (active_model_mae - baseline_mae) / baseline_mae > 1.05 - 1 THEN 'DEGRADED'
              ELSE 'OK' END AS status,
         {_ts(P.EVAL_TS)} AS evaluation_timestamp
  FROM am""")
    rb = drift + runs + [("severe", SEVERE), ("per_role", DEV_PER_ROLE), ("role_piv", ROLE_PIVOT), ("rb", ROLLBACK)]
    q["rollback_decision"] = with_(rb, """
  SELECT evaluation_timestamp, severe_drift, round(baseline_mae, 6) AS baseline_mae,
         round(challenger_mae, 6) AS challenger_mae, rollback_required FROM rb""")
    q["pointer_after_rollback"] = with_(rb + dec + [
        ("chosen", """
  SELECT * FROM rb WHERE severe_drift AND evaluation_timestamp = (SELECT max(evaluation_timestamp) FROM rb WHERE severe_drift)
    AND rollback_required"""),
        ("log", f"""
  SELECT * FROM model_decisions UNION ALL
  SELECT 'BASELINE' AS active_model, baseline_run_id AS model_run_id, 'AUTO_ROLLBACK' AS reason,
         {_ts(P.EVAL_TS)} AS decision_timestamp FROM chosen"""),
    ], "SELECT * FROM log ORDER BY decision_timestamp DESC, model_run_id DESC LIMIT 1")
    q["pointer_restamped"] = with_(
        dec + [("active", ACTIVE)],
        f"SELECT active_model, model_run_id, reason, {_ts(P.EVAL_TS)} AS decision_timestamp FROM active",
    )
    return q


ORACLES: dict[str, str] = _oracles()
