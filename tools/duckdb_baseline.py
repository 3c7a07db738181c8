"""Single-node comparison point: the page queries' SQL on embedded DuckDB.

    python tools/duckdb_baseline.py [sf_dir]

The reference runs its page as SQL on an embedded DuckDB database. The oracle SQL
of the page keys is that SQL over the same stand-in views the Spark queries read,
so its DuckDB time is the single-node figure to hold the engine's against. Only
page keys are timed: the oracle of the decode keys reads the tables directly (no
JSON), so its time would not be comparable. Prints one JSON line; each figure is
the best of three runs, result fetched as Arrow.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tools.oracle_check import TABLES  # noqa: E402
from usagelens.plans import catalog  # noqa: E402

PAGE_KEYS = ["kpi", "model_usage", "cost_by_practice", "cost_share", "daily_usage", "hour_dow", "usage_heatmap",
             "tokens_by_level", "tool_success", "top_errors", "error_label_totals", "cost_by_location",
             "top_engineers", "kpi_filtered", "filter_options", "date_bounds"]


def main() -> None:
    sf_dir = (sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1").rstrip("/")
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    sql = catalog.oracle_sql()
    times = {}
    for key in PAGE_KEYS:
        best = float("inf")
        for _ in range(3):
            t0 = time.perf_counter()
            con.sql(sql[key]).to_arrow_table()
            best = min(best, time.perf_counter() - t0)
        times[key] = round(best, 4)
    print(json.dumps({"engine": "duckdb " + duckdb.__version__, "threads": con.execute(
        "SELECT current_setting('threads')").fetchone()[0], "sf_dir": sf_dir, "value": round(sum(times.values()), 4),
        "queries": times}))


if __name__ == "__main__":
    main()
