"""Command line: load log files and the employee CSV, then show the page.

    python -m usagelens load --telemetry logs/ --employees employees.csv --root /data/usage
    python -m usagelens page --root /data/usage --practice ML --start 2026-01-01 --end 2026-01-31

Runs under ``spark-submit`` too (the session comes from the submit settings).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from usagelens.operators.filters import UsageFilters, date_bounds, filter_options
from usagelens.operators.rollups import UsagePage
from usagelens.session import SEMANTIC_CONF, checkpoint_dir
from usagelens.sources import store

PAGE = ["kpi", "model_usage", "cost_by_practice", "cost_share", "daily_usage", "usage_heatmap",
        "tokens_by_level", "tool_success", "error_label_totals", "cost_by_location", "top_engineers"]


def session() -> SparkSession:
    spark = SparkSession.builder.appName("usagelens").getOrCreate()
    for k, v in SEMANTIC_CONF.items():
        spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def cmd_load(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.employees:
        added = store.append_employees(spark, a.root, a.employees)
        print(f"employees added: {added:,}")
    if a.telemetry:
        rep = store.load_telemetry(spark, a.root, a.telemetry, files_per_day=a.files_per_day,
                                   layout=a.layout, spread_input="always" if a.spread_input else True)
        for k in ("api_requests", "user_prompts", "tool_events", "api_errors", "skipped",
                  "total_events", "malformed_lines"):
            print(f"{k:16s}: {rep.counts[k]:>12,}")
        print(f"load id         : {rep.load_id}")


def show_all(frame) -> None:
    """Every row, as tab-separated lines, fetched a partition at a time."""
    print("\t".join(frame.columns))
    for row in frame.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def cmd_page(spark: SparkSession, a: argparse.Namespace) -> None:
    tables = store.stored_tables(spark, a.root)
    if a.options:
        show_all(filter_options(tables.employees, tables.api_requests))
        show_all(date_bounds(tables.api_requests))
        return
    f = UsageFilters(practices=a.practice, levels=a.level, locations=a.location, models=a.model,
                     start=a.start, end=a.end, end_day="whole" if a.whole_end_day else "midnight")
    page = UsagePage(tables, f)
    if a.shared:
        page.share()
    try:
        for name in a.only or PAGE:
            print(f"== {name}")
            show_all(getattr(page, name)())
    finally:
        page.unshare()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="usagelens")
    sub = p.add_subparsers(dest="cmd", required=True)
    ld = sub.add_parser("load", help="load log-batch JSON lines and/or the employee CSV")
    ld.add_argument("--root", required=True)
    ld.add_argument("--telemetry", nargs="*")
    ld.add_argument("--employees", nargs="*")
    ld.add_argument("--files-per-day", type=int, default=None)
    ld.add_argument("--layout", choices=["rebalance", "narrow"], default="rebalance",
                    help="shuffle rows to steady file sizes (default), or write where they are")
    ld.add_argument("--spread-input", action="store_true",
                    help="rebalance raw lines before decoding (one large gzip file holds much of the input)")
    pg = sub.add_parser("page", help="show the usage page")
    pg.add_argument("--root", required=True)
    for name in ("practice", "level", "location", "model"):
        pg.add_argument(f"--{name}", nargs="*", default=None)
    pg.add_argument("--start")
    pg.add_argument("--end")
    pg.add_argument("--whole-end-day", action="store_true")
    pg.add_argument("--shared", action="store_true", help="scan the request facts once for the page")
    pg.add_argument("--only", nargs="*", choices=PAGE + ["hour_dow", "top_errors"])
    pg.add_argument("--options", action="store_true", help="show the picker options and date bounds")
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = session()
    {"load": cmd_load, "page": cmd_page}[a.cmd](spark, a)
    return 0


if __name__ == "__main__":
    sys.exit(main())
