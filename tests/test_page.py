"""Page queries: DuckDB oracle, both join shapes, cross-query properties, edges (FIXTURES §4.5)."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from tools.oracle_check import TABLES, digest
from usagelens.operators.filters import UsageFilters
from usagelens.operators.rollups import UsagePage
from usagelens.plans import catalog
from usagelens.schemas import EMPLOYEES, FACT_SCHEMAS
from usagelens.sources.standin import standin_tables
from usagelens.tables import UsageTables

QUERIES = catalog.queries()
ORACLE = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


PAGE_METHODS = ["kpi", "model_usage", "cost_by_practice", "cost_share", "daily_usage", "hour_dow",
                "usage_heatmap", "tokens_by_level", "tool_success", "top_errors", "error_label_totals",
                "cost_by_location", "top_engineers"]


@pytest.fixture(scope="module")
def pages(spark):
    t = standin_tables(spark, SF_SMALL)
    return UsagePage(t, broadcast=True), UsagePage(t, broadcast=False)


@pytest.mark.parametrize("method", PAGE_METHODS)
def test_shuffle_shape_equals_broadcast_shape(pages, method):
    b, s = pages
    x, y = getattr(b, method)(), getattr(s, method)()
    assert sorted(map(tuple, x.collect())) == sorted(map(tuple, y.collect()))


def test_cross_query_properties(pages):
    page = pages[0]
    kpi = page.kpi().first()
    calls = kpi.total_api_calls
    for q, col in [("model_usage", "api_calls"), ("cost_by_practice", "api_calls"),
                   ("daily_usage", "api_calls"), ("hour_dow", "calls"), ("cost_by_location", "api_calls")]:
        assert getattr(page, q)().agg(F.sum(col)).first()[0] == calls, q
    hm = page.usage_heatmap()
    cells = sum(sum(r[f"h{h:02d}"] for h in range(24)) for r in hm.collect())
    assert cells == calls
    share = page.cost_share().agg(F.sum("cost_share")).first()[0]
    assert abs(share - 1.0) < 1e-5


def literal_tables(spark, requests, employees):
    emp = spark.createDataFrame(employees, EMPLOYEES)
    req = spark.createDataFrame(requests, FACT_SCHEMAS["api_requests"])
    empty = {n: spark.createDataFrame([], s) for n, s in FACT_SCHEMAS.items() if n != "api_requests"}
    return UsageTables(employees=emp, api_requests=req, **empty)


def req(i, ts, email="a", model="m", cost=1.0):
    return (str(i), f"s{i}", email, ts, model, cost, 1, 2, 0, 0, 0, "", "", "")


def test_end_day_midnight_vs_whole(spark):
    rows = [req(1, dt.datetime(2026, 1, 31, 0, 0, 0)), req(2, dt.datetime(2026, 1, 31, 0, 0, 1)),
            req(3, dt.datetime(2026, 1, 30, 12))]
    t = literal_tables(spark, rows, [("a", "Ann", "ML", "L1", "Paris")])
    mid = UsagePage(t, UsageFilters(start="2026-01-30", end="2026-01-31")).kpi().first()
    whole = UsagePage(t, UsageFilters(start="2026-01-30", end="2026-01-31", end_day="whole")).kpi().first()
    assert mid.total_api_calls == 2 and whole.total_api_calls == 3
    default = UsagePage(t).kpi().first()   # page default range: min..max date, end at midnight
    assert default.total_api_calls == 2


def test_null_timestamp_unknown_email_and_empty_pick(spark):
    rows = [req(1, None), req(2, dt.datetime(2026, 1, 2), email="zz"), req(3, dt.datetime(2026, 1, 2))]
    t = literal_tables(spark, rows, [("a", "Ann", "ML", "L1", "Paris")])
    k = UsagePage(t, UsageFilters(start="2026-01-01", end="2026-01-03")).kpi().first()
    assert k.total_api_calls == 1
    e = UsagePage(t, UsageFilters(models=(), start="2026-01-01", end="2026-01-03")).kpi().first()
    assert (e.total_sessions, e.total_api_calls, e.total_cost, e.total_tokens, e.active_users) == (0, 0, None, None, 0)


def test_weekday_labels(spark):
    rows = [req(1, dt.datetime(2026, 2, 1, 10)), req(2, dt.datetime(2026, 2, 2, 11)), req(3, dt.datetime(2026, 2, 7, 12))]
    t = literal_tables(spark, rows, [("a", "Ann", "ML", "L1", "Paris")])
    p = UsagePage(t, UsageFilters(start="2026-02-01", end="2026-02-08"))
    assert sorted((r.dow, r.hour) for r in p.hour_dow().collect()) == [(1, 10), (2, 11), (7, 12)]
    hm = [(r.day_order, r.day_name, r.h10, r.h11, r.h12) for r in p.usage_heatmap().collect()]
    assert hm == [(1, "Mon", 0, 1, 0), (6, "Sat", 0, 0, 1), (7, "Sun", 1, 0, 0)]


def test_labels_and_percent(spark):
    from usagelens.functions import error_label, model_short_name

    df = spark.createDataFrame([("claude-haiku-4-5-20251001", "x" * 50), ("v-opus-4-6", "short"), ("m", None)],
                               "m string, e string")
    got = df.select(model_short_name("m").alias("s"), model_short_name("m", "v-").alias("v"),
                    error_label("e").alias("l")).collect()
    assert got[0].s == "haiku-4-5" and got[1].v == "opus-4-6"
    assert got[0].l == "x" * 45 + "..." and got[1].l == "short..." and got[2].l is None
    rows = [("1", "s", "a", dt.datetime(2026, 1, 1), "result", "T", None, ok, 1) for ok in (True, True, False)]
    emp = spark.createDataFrame([("a", "Ann", "ML", "L1", "Paris")], EMPLOYEES)
    tools = spark.createDataFrame(rows, FACT_SCHEMAS["tool_events"])
    t = UsageTables(employees=emp, tool_events=tools,
                    **{n: spark.createDataFrame([], s) for n, s in FACT_SCHEMAS.items() if n != "tool_events"})
    t.api_requests = spark.createDataFrame([req(1, dt.datetime(2026, 1, 1))], FACT_SCHEMAS["api_requests"])
    r = UsagePage(t, UsageFilters(start="2026-01-01", end="2026-01-02")).tool_success().first()
    assert (r.uses, r.success_rate) == (3, 66.7)


def test_leaderboard_ties_are_deterministic(spark):
    emps = [(f"e{i}", f"N{i:02d}", "ML", "L1", "Paris") for i in range(30)]
    rows = [req(i, dt.datetime(2026, 1, 1, 1), email=f"e{i}") for i in range(30)]
    t = literal_tables(spark, rows, emps)
    top = UsagePage(t, UsageFilters(start="2026-01-01", end="2026-01-02")).top_engineers().collect()
    assert [r.full_name for r in top] == [f"N{i:02d}" for i in range(20)]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["day", "api_calls", "daily_cost"]


REQUEST_ROLLUPS = ["kpi", "model_usage", "cost_by_practice", "cost_share", "daily_usage", "hour_dow",
                   "usage_heatmap", "tokens_by_level", "cost_by_location", "top_engineers"]


@pytest.mark.parametrize("broadcast", [True, False])
def test_shared_base_gives_the_same_page(spark, broadcast):
    t = standin_tables(spark, SF_SMALL)
    plain = UsagePage(t, broadcast=broadcast)
    shared = UsagePage(t, broadcast=broadcast).share()
    try:
        for m in REQUEST_ROLLUPS:
            a = sorted(map(tuple, getattr(plain, m)().collect()))
            b = sorted(map(tuple, getattr(shared, m)().collect()))
            assert a == b, m
        p = shared.kpi()._jdf.queryExecution().executedPlan().toString()
        assert "InMemoryTableScan" in p
    finally:
        shared.unshare()
