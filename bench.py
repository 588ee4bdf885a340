"""Benchmark the headline queries; print one JSON line.

Environment:
  BENCH_SF_DIR  scale directory (default /root/testdata/sf0.1)
  BENCH_CPUS    local[N] cores (default 8)
  BENCH_RUNS    timed runs per query after one warm-up (default 5)
  BENCH_ORACLE  1 (default) also times the DuckDB oracle SQL per query

Each Spark query is fully materialised with the ``noop`` sink (every
row and column computed, nothing collected to the driver).  The metric
is the sum of per-query medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "stg_daily_prices",
    "price_indicators",
    "fact_daily_performance",
    "weekly_performance",
    "weekly_performance_day_grain",
    "silver_prices",
    "gold_daily_summary",
    "symbol_detail",
    "price_history",
    "dq_report",
    "dq_model_tests",
    "safe_divide",
    "parse_daily_responses",
    "parse_history_frame",
]

TABLES = ["orders"]


def _fetch(cursor):
    """Materialise a DuckDB result as Arrow (API name differs by version)."""
    for name in ("to_arrow_table", "fetch_arrow_table", "arrow"):
        if hasattr(cursor, name):
            return getattr(cursor, name)()
    return cursor.fetchall()


def _median_time(fn, runs: int) -> float:
    fn()  # warm-up
    times = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return statistics.median(times)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    with_oracle = os.environ.get("BENCH_ORACLE", "1") == "1"

    from tickhouse.plans.catalog import ORACLE_SQL, QUERIES
    from tickhouse.session import build_session

    spark = build_session(f"local[{cpus}]", cpus, app_name="tickhouse-bench")

    results: dict[str, float] = {}
    for name in HEADLINE:
        df = QUERIES[name](spark, sf_dir)
        results[name] = round(
            _median_time(lambda df=df: df.write.format("noop").mode("overwrite").save(), runs), 4
        )

    # end to end: raw -> Bronze -> Silver -> checks -> Gold -> marts (writes
    # a fresh lake under the scratch root on every run)
    results["medallion_run_end_to_end"] = round(
        _median_time(lambda: QUERIES["medallion_run_summary"](spark, sf_dir).collect(),
                     max(1, runs // 2)),
        4,
    )
    spark.stop()

    oracle: dict[str, float] = {}
    if with_oracle:
        import duckdb

        con = duckdb.connect()
        con.execute(f"set threads = {cpus}")
        for t in TABLES:
            con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
        for name in HEADLINE:
            sql = ORACLE_SQL[name]
            oracle[name] = round(
                _median_time(lambda sql=sql: _fetch(con.execute(sql)), runs), 4
            )

    sf = Path(sf_dir).name.replace("sf", "")
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 4),
        "unit": "sec",
        "queries": results,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
    }
    if oracle:
        out["oracle_duckdb_same_sql"] = oracle
        out["oracle_duckdb_total"] = round(sum(oracle.values()), 4)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
