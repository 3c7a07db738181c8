"""Plan checks: broadcast join, pushed filters, pruned reads, no Python, bounded windows."""

import pytest

from conftest import SF_SMALL
from usagelens.operators.rollups import UsagePage
from usagelens.plans import catalog
from usagelens.sources.standin import standin_tables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    return standin_tables(spark, SF_SMALL)


def test_broadcast_shape(tables):
    p = plan(UsagePage(tables, broadcast=True).kpi())
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    assert "EqualTo(event_type,purchase)" in p                      # routing filter reaches the scan
    assert "GreaterThanOrEqual(ts," in p                             # date range reaches the scan
    events_scan = [ln for ln in p.splitlines() if "events.parquet" in ln or "ReadSchema" in ln]
    assert any("ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string>"
               in ln for ln in events_scan)                          # event_id never read
    assert "Python" not in p


def test_shuffle_shape_aggregates_before_the_join(tables):
    p = plan(UsagePage(tables, broadcast=False).cost_by_practice())
    lines = p.splitlines()
    join_at = next(i for i, ln in enumerate(lines) if "SortMergeJoin" in ln or "ShuffledHashJoin" in ln)
    below = "\n".join(lines[join_at:])
    assert "HashAggregate(keys=[user_email" in below                  # facts collapsed per user first
    assert "BroadcastHashJoin [user_email" not in p                  # only code tables broadcast


def test_employee_filters_reach_the_dimension_scan(spark, tables):
    from usagelens.plans.catalog import NARROWED

    p = plan(UsagePage(tables, NARROWED, broadcast=True).kpi())
    assert "In(c_mktsegment" in p


@pytest.mark.parametrize("name", ["cost_share", "error_label_totals"])
def test_windows_run_over_rolled_up_rows(spark, name):
    p = plan(catalog.queries()[name](spark, SF_SMALL))
    lines = p.splitlines()
    win = next(i for i, ln in enumerate(lines) if "Window [" in ln)
    assert any("HashAggregate" in ln for ln in lines[win:]), "window must sit above the aggregate"


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_python_in_any_registered_query(spark, name):
    assert "Python" not in plan(catalog.queries()[name](spark, SF_SMALL))


def test_envelope_packing_has_no_window(spark):
    p = plan(catalog.queries()["envelope_pack"](spark, SF_SMALL))
    assert "rangepartitioning" in p and "Window" not in p


def test_registered_store_query_prunes_days(spark):
    """The page query over a freshly loaded store reads only the folders of its days."""
    p = plan(catalog.queries()["stored_daily_usage"](spark, SF_SMALL))
    scans = [ln for ln in p.splitlines() if "PartitionFilters" in ln]
    assert any("event_date" in ln.split("PartitionFilters")[1].split("]")[0] for ln in scans)


def test_registered_stream_load_restart_adds_nothing(spark):
    rows = {r.fact_table: r.rows for r in catalog.queries()["stream_load"](spark, SF_SMALL).collect()}
    t = catalog.tables(spark, SF_SMALL)
    # Two sources, each loaded once.
    assert rows == {n: 2 * t.fact(n).count() for n in ("api_requests", "user_prompts", "tool_events", "api_errors")}


def test_log_lines_are_kept_once_and_packed(spark):
    path = catalog._log_files(spark, SF_SMALL)
    files = catalog._log_lines(spark, SF_SMALL).inputFiles()
    folder = path.rpartition("/")[2]
    assert files and all(f"/{folder}/" in f and f.endswith(".gz") for f in files)


def test_wide_cost_sums_are_not_expanded_with_distinct_counts(spark):
    from dataclasses import replace

    from usagelens.operators.costs import BinnedCosts
    from usagelens.operators.filters import UsageFilters
    from usagelens.sources.standin import extreme_requests

    t = catalog.tables(spark, SF_SMALL)
    page = UsagePage(replace(t, api_requests=extreme_requests(t.api_requests, True)), UsageFilters())
    plan = page.kpi()._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" in plan and not any("Expand" in x and "cost_" in x for x in plan.splitlines())
    # The text of a cost is made once, however many pieces are cut from it.
    prepared = BinnedCosts().prepare(t.api_requests)._jdf.queryExecution().optimizedPlan().toString()
    assert prepared.count("format_string") <= 2
