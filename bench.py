"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run once to warm up, then timed $BENCH_REPEATS times (median
reported).  A query is timed end to end: building the plan (and, for
model queries, fitting) plus executing it into Spark's ``noop`` sink, which
materialises every column without collecting to the driver.

Queries on the gold layer read a layer that is written once; writing it is
the line ``gold_build`` (the first, cold build in ``gold_build_cold``).

Prints ONE JSON line: {"metric", "value", "unit", "queries", "rows", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from demandlake.plans import catalog  # noqa: E402
from demandlake.plans.catalog import QUERIES as LAYER_QUERIES  # noqa: E402
from demandlake.plans.model_catalog import MODEL_QUERIES  # noqa: E402
from demandlake.session import get_session  # noqa: E402

QUERIES = {**LAYER_QUERIES, **MODEL_QUERIES}
HEADLINE = [
    "gold_features",
    "silver_latest",
    "feature_psi",
    "forecast_mae_rmse",
    "ols_normal_equations",
    "forest_invariants",
    "gold_projection",
    "feature_histogram",
    "model_comparison",
    "rollback_decision",
]


def _build_gold(spark, sf_dir) -> float:
    """Seconds to build and write the gold layer anew."""
    catalog._GOLD_ROOTS.clear()
    t0 = time.perf_counter()
    catalog._gold_table(spark, sf_dir)
    return time.perf_counter() - t0


def _run(spark, name, sf_dir):
    t0 = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0, df


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = get_session("demandlake-bench", cores=cpus, shuffle_partitions=int(cpus) * 2)
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    cold = _build_gold(spark, sf_dir)
    times["gold_build"] = round(statistics.median(_build_gold(spark, sf_dir) for _ in range(repeats)), 3)
    for name in names:
        _, df = _run(spark, name, sf_dir)  # warm-up
        rows[name] = df.count()
        samples = [_run(spark, name, sf_dir)[0] for _ in range(repeats)]
        times[name] = round(statistics.median(samples), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "gold_build_cold": round(cold, 3),
        "rows": rows,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        "repeats": repeats,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
