"""A dimension too large to broadcast: buckets without a shuffle, picked emails in the fact scan."""

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from test_plans import plan
from test_skew import N, skewed_tables
from usagelens.operators.filters import UsageFilters
from usagelens.operators.mailfilter import LEAST_BITS, build_mail_filter, filter_bits
from usagelens.operators.rollups import UsagePage
from usagelens.plans.catalog import NARROWED
from usagelens.sources import buckets
from usagelens.sources.standin import standin_tables

DAYS = UsageFilters(start="2026-01-01", end="2026-01-02")
METHODS = ("kpi", "cost_by_practice", "top_engineers", "tokens_by_level", "cost_by_location", "daily_usage")


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    name, t = f"t_{uuid.uuid4().hex[:8]}", skewed_tables(spark)
    nobody = t.api_requests.limit(50).withColumn("user_email", F.lit(None).cast("string"))
    t.api_requests = t.api_requests.unionByName(nobody)
    buckets.write_buckets(spark, t, name, str(tmp_path_factory.mktemp("buckets")), 8)
    return t, buckets.bucketed_tables(spark, t, name)


def test_buckets_hold_every_row_and_cut_the_hot_user(stored):
    plain, cut = stored
    assert rows(cut.api_requests.drop("bucket_salt", "event_date")) == rows(plain.api_requests)
    hot = {r.bucket_salt: r["count"] for r in cut.api_requests.where("user_email = 'hot'").groupBy("bucket_salt").count().collect()}
    assert set(hot) == {0, 1, 2} and max(hot.values()) < N / 8      # a third of all rows: 3 of 8 buckets
    assert cut.employees.where("email = 'hot'").count() == 3
    assert cut.employees.where("email != 'hot'").count() == plain.employees.count() - 1
    assert cut.api_requests.where("user_email IS NULL").select("bucket_salt").distinct().count() > 1


@pytest.mark.parametrize("broadcast", [False, True])
def test_pages_over_buckets_equal_plain_pages(stored, broadcast):
    plain, cut = stored
    a, b = UsagePage(plain, DAYS, broadcast=True), UsagePage(cut, DAYS, broadcast=broadcast)
    for m in METHODS:
        assert rows(getattr(a, m)()) == rows(getattr(b, m)()), m
    b.share()
    for m in METHODS:
        assert rows(getattr(a, m)()) == rows(getattr(b, m)()), m
    b.unshare()


def test_no_exchange_below_the_bucketed_join(stored):
    page = UsagePage(stored[1], DAYS, broadcast=False)
    lines = plan(page.joined("api_requests", {"session_id": F.col("session_id")}, {"n": F.lit(1).cast("long")}, ["practice"])).splitlines()
    join = next(i for i, ln in enumerate(lines) if "SortMergeJoin" in ln)
    assert not any("Exchange" in ln for ln in lines[join:])
    assert sum("Bucketed: true" in ln for ln in lines[join:]) == 2


def test_mail_filter_lets_every_picked_email_pass_and_few_others(spark):
    emp = spark.range(20000).select(F.concat(F.lit("u"), "id").alias("email"), (F.col("id") % 10).alias("k"))
    emp = emp.unionByName(spark.createDataFrame([(None, 0)], "email string, k long"))
    f = build_mail_filter(emp, F.col("k") == 0)
    assert f.bits == filter_bits(2000) == 1 << 15
    got = emp.withColumn("user_email", F.col("email")).where(f.passes("user_email"))
    seen = {bool(r.k): r["count"] for r in got.groupBy((F.col("k") != 0).alias("k")).count().collect()}
    assert seen[False] == 2000 and seen.get(True, 0) < 18000 * 0.02
    assert build_mail_filter(emp, F.col("k") < 6) is None
    none = build_mail_filter(emp, F.col("k") > 10)
    assert none.bits == LEAST_BITS and emp.where(none.passes("email")).count() == 0
    assert build_mail_filter(emp.limit(0), F.lit(True)) is not None


def test_picked_emails_reach_the_fact_scan(spark):
    t = standin_tables(spark, SF_SMALL)
    page = UsagePage(t, NARROWED, broadcast=False)
    lines = plan(page.kpi()).splitlines()
    last = len(lines) - 1 - next(i for i, ln in enumerate(reversed(lines)) if "HashAggregate(keys=[user_email" in ln)
    assert any("getbit" in ln and "Filter" in ln for ln in lines[last:])  # below the partial aggregate
    wide, narrow = UsagePage(t, NARROWED, broadcast=True), t.api_requests.where(page.mail_filter.passes("user_email"))
    assert wide.mail_filter is None and UsagePage(t, broadcast=False).mail_filter is None
    picked = t.api_requests.join(t.employees.where(NARROWED.employee_predicate()), F.col("user_email") == F.col("email")).count()
    assert picked <= narrow.count() <= picked + 0.03 * t.api_requests.count()
    for m in ("kpi", "top_engineers", "tool_success", "top_errors"):
        assert rows(getattr(page, m)()) == rows(getattr(wide, m)()), m
