"""D5-D8 on the literal cases of FIXTURES §4.3."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from usagelens.functions import parse_event_ts, safe_bool, safe_float, safe_int, strip_ws

INT_FLOAT = [
    ("12", 12, 12.0), ("12.7", 12, 12.7), ("-12.7", -12, -12.7), (" 12 ", 12, 12.0),
    ("1e3", 1000, 1000.0), ("nan", 0, float("nan")), ("inf", 0, float("inf")),
    ("", 0, 0.0), (None, 0, 0.0), ("abc", 0, 0.0), ("0x10", 0, 0.0), ("12d", 0, 0.0),
    ("1_000", 1000, 1000.0), ("1__0", 0, 0.0), ("_1", 0, 0.0), ("99999999999", 99999999999, 99999999999.0),
    ("1e30", 0, 1e30), ("9007199254740993", 9007199254740992, 9007199254740992.0), ("-0.5", 0, -0.5), (".5", 0, 0.5),
    ("+3.", 3, 3.0), ("-Infinity", 0, float("-inf")),
]


def test_safe_int_and_float(spark):
    df = spark.createDataFrame([(x,) for x, _, _ in INT_FLOAT], "x string")
    got = df.select("x", safe_int("x").alias("i"), safe_float("x").alias("f")).collect()
    for (x, want_i, want_f), row in zip(INT_FLOAT, got):
        assert row.x == x
        assert row.i == want_i, x
        if math.isnan(want_f):
            assert math.isnan(row.f), x
        else:
            assert row.f == want_f, x


TS = [
    ("2026-01-31T12:00:00.123Z", dt.datetime(2026, 1, 31, 12, 0, 0, 123000)),
    ("2026-01-31T12:00:00.123456Z", dt.datetime(2026, 1, 31, 12, 0, 0, 123456)),
    ("2026-1-3T1:2:3.1Z", dt.datetime(2026, 1, 3, 1, 2, 3, 100000)),
    ("2026-01-31t12:00:00.5z", dt.datetime(2026, 1, 31, 12, 0, 0, 500000)),
    ("2026-01-31T12:00:00Z", None),
    ("2026-01-31T12:00:00.123+00:00", None),
    ("2026-01-31T12:00:00.1234567Z", None),
    ("2026-02-30T12:00:00.123Z", None),
    ("2026-01-31T24:00:00.123Z", None),
    ("", None),
    (None, None),
]


def test_parse_event_ts(spark):
    df = spark.createDataFrame([(x,) for x, _ in TS], "x string")
    got = [r.t for r in df.select(parse_event_ts("x").alias("t")).collect()]
    assert got == [want for _, want in TS]


def test_safe_bool(spark):
    cases = [("true", True), ("True", True), ("TRUE", True), ("false", False), ("1", False),
             ("yes", False), ("", False), (None, False)]
    df = spark.createDataFrame([(x,) for x, _ in cases], "x string")
    got = [r.b for r in df.select(safe_bool("x").alias("b")).collect()]
    assert got == [w for _, w in cases]


def test_strip_ws_strips_all_whitespace(spark):
    df = spark.createDataFrame([(" \t a b \r\n",)], "x string")
    assert df.select(strip_ws("x").alias("y")).first().y == "a b"


@pytest.mark.parametrize("expr", ["safe_int", "safe_float", "safe_bool", "parse_event_ts"])
def test_casts_stay_in_the_jvm(spark, expr):
    import usagelens.functions as U

    df = spark.createDataFrame([("1",)], "x string").select(getattr(U, expr)(F.col("x")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_format_event_ts(spark):
    import datetime as dt

    rows = [(dt.datetime(2024, 1, 1, 0, 0, 7, 179575),), (dt.datetime(2024, 3, 10, 2, 30, 0),),
            (dt.datetime(2024, 1, 1, 0, 0, 7, 100000),), (None,)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    from usagelens.functions import format_event_ts

    got = [r.s for r in df.select(format_event_ts("t").alias("s")).collect()]
    assert got == ["2024-01-01T00:00:07.179Z", "2024-03-10T02:30:00.000Z", "2024-01-01T00:00:07.100Z", None]


def test_results_do_not_depend_on_the_session_zone(spark):
    from conftest import SF_SMALL
    from usagelens.plans import catalog

    q = catalog.queries()
    names = ["kpi_filtered", "hour_dow", "facts_requests", "safe_casts", "envelope_pack", "stored_daily_usage"]
    base = {n: sorted(map(tuple, q[n](spark, SF_SMALL).collect())) for n in names}
    other = spark.newSession()          # own settings, plans built afresh
    other.conf.set("spark.sql.session.timeZone", "America/New_York")
    for n in names:
        assert sorted(map(tuple, q[n](other, SF_SMALL).collect())) == base[n], n


def test_lookup_absent_null_and_missing_map(spark):
    from usagelens.functions.casts import lookup

    rows = [({"a": "1", "n": None},), ({},), (None,)]
    df = spark.createDataFrame(rows, "m map<string,string>")
    got = [tuple(r) for r in df.select(lookup("m", "a").alias("a"), lookup("m", "n").alias("n"),
                                       lookup("m", "z").alias("z")).collect()]
    assert got == [("1", None, ""), ("", "", ""), ("", "", "")]
