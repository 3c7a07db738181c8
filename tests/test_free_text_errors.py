"""The top errors where most messages are unique: bucket bounds, then exact counts of few groups."""

import pytest
from pyspark.sql import functions as F

from test_plans import plan
from usagelens.operators.filters import UsageFilters
from usagelens.operators.rollups import UsagePage
from usagelens.schemas import EMPLOYEES, FACT_SCHEMAS
from usagelens.tables import UsageTables

DAYS = UsageFilters(start="2026-01-01", end="2026-01-02")


def error_tables(spark, n, message, email="a"):
    ids = spark.range(n)
    rows = ids.select(F.col("id").cast("string").alias("event_id"), F.lit(email).alias("user_email"),
                      F.lit("2026-01-01 10:00:00").cast("timestamp_ntz").alias("timestamp"),
                      F.when(F.col("id") % 5 != 0, F.concat(F.lit("m"), F.col("id") % 2)).alias("model"), message(F.col("id")).alias("error_message"))
    schema = FACT_SCHEMAS["api_errors"]
    rows = rows.select([(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
    empty = {t: spark.createDataFrame([], s) for t, s in FACT_SCHEMAS.items() if t != "api_errors"}
    emp = spark.createDataFrame([("a", "A", "ML", "L1", "Rome"), ("b", "B", "Data", "L1", "Rome")], EMPLOYEES)
    return UsageTables(employees=emp, api_errors=rows.repartition(4), **empty)


MESSAGES = {
    "frequent and unique": lambda i: F.when(i % 4 == 0, F.concat(F.lit("e"), i % 15)).otherwise(F.concat(F.lit("id "), i)),
    "all unique": lambda i: F.concat(F.lit("id "), i),
    "one": lambda i: F.lit("same"),
    "fewer groups than asked": lambda i: F.concat(F.lit("e"), i % 2),
    "null and empty": lambda i: F.when(i % 3 == 0, F.lit("")).when(i % 3 == 1, F.concat(F.lit("id "), i)),
}


@pytest.mark.parametrize("kind", MESSAGES)
@pytest.mark.parametrize("buckets", [7, 1 << 16])
def test_equal_to_the_full_query(spark, kind, buckets):
    t = error_tables(spark, 3000, MESSAGES[kind])
    picked = UsageFilters(practices=["ML"], start="2026-01-01", end="2026-01-02")
    for page in (UsagePage(t, DAYS, broadcast=True), UsagePage(t, picked, broadcast=False)):
        assert page.top_errors_free_text(10, buckets).collect() == page.top_errors(10).collect()


def test_the_join_leaves_the_fullest_buckets_empty(spark):
    """The most frequent messages are of users without an employee row."""
    a = error_tables(spark, 3000, lambda i: F.concat(F.lit("e"), i % 40), "nobody")
    b = error_tables(spark, 300, lambda i: F.concat(F.lit("f"), i % 20))
    a.api_errors = a.api_errors.unionByName(b.api_errors)
    page = UsagePage(a, DAYS)
    got = page.top_errors_free_text(5).collect()
    assert got == page.top_errors(5).collect() and all(r.error_message.startswith("f") for r in got)
    assert UsagePage(error_tables(spark, 0, lambda i: F.lit("x")), DAYS).top_errors_free_text().count() == 0


def test_few_groups_reach_the_last_count(spark):
    t = error_tables(spark, 20000, MESSAGES["frequent and unique"])
    page = UsagePage(t, DAYS)
    frame = page.top_errors_free_text()
    assert "LeftSemi" in plan(frame)
    seen = []
    full = page.top_errors
    page.top_errors = lambda top, keep: seen.append(keep(t.api_errors).select("model", "error_message").distinct().count()) or full(top, keep)
    assert page.top_errors_free_text().collect() == frame.collect()
    groups = t.api_errors.select("model", "error_message").distinct().count()
    assert groups > 15000 and max(seen) < 0.02 * groups
