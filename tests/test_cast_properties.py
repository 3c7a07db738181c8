"""The guarded casts agree with Python's float()/int()/strptime() on generated text.

Thousands of inputs are drawn (fixed seed) from the number and timestamp grammars
with near misses, and checked in one Spark job each. The documented gaps (non-ASCII
digits or blanks) are not generated."""

import datetime as dt
import math
import random

from usagelens.functions import parse_event_ts, safe_float, safe_int

RND = random.Random(20261202)


def digits(lo=0, hi=6):
    return "".join(RND.choice("01234567890123456789_") for _ in range(RND.randint(lo, hi)))


def number_text():
    return "".join([
        RND.choice(["", " ", "\t", " \n"]), RND.choice(["", "+", "-", "--"]), digits(),
        RND.choice(["", ".", ".."]), digits(),
        RND.choice(["", "e3", "E-2", "e", "e+10", "e400", "d", "x"]), RND.choice(["", " ", "\r\n"]),
    ])


SPECIAL = ["inf", "-Infinity", "NaN", "+nan", "-NAN", " nan ", "INF", "infinit", "nanx", "0x10", "", "+.e1"]


def py_float(x):
    try:
        return float(x)
    except (TypeError, ValueError):
        return 0.0


def py_int(x):
    try:
        v = int(float(x))
    except (TypeError, ValueError, OverflowError):   # the reference stops on inf; we give 0
        return 0
    return v if -2**63 <= v < 2**63 else 0           # beyond the BIGINT column: 0


def test_safe_float_and_int_match_python(spark):
    xs = [number_text() for _ in range(5000)] + SPECIAL + [None]
    got = spark.createDataFrame([(x,) for x in xs], "x string").select(
        "x", safe_float("x").alias("f"), safe_int("x").alias("i")).collect()
    bad = []
    for r in got:
        f = py_float(r.x)
        same_f = (math.isnan(f) and r.f is not None and math.isnan(r.f)) or r.f == f
        if not same_f or r.i != py_int(r.x):
            bad.append((r.x, r.f, r.i))
    assert not bad, bad[:10]


def ts_text():
    two = lambda: RND.choice([str(RND.randint(0, 99)), f"0{RND.randint(0, 9)}", str(RND.randint(0, 9))])
    return "".join([
        RND.choice(["2024", "2026", "1999", "24", "02024"]), "-",
        RND.choice([str(RND.randint(0, 13)), f"0{RND.randint(1, 9)}"]), "-",
        RND.choice([str(RND.randint(0, 32)), f"0{RND.randint(1, 9)}", " 5"]),
        RND.choice(["T", "T", "t", " "]), two(), ":", two(), ":", two(), ".", digits(0, 7),
        RND.choice(["Z", "Z", "z", "", "+00:00"]),
    ])


def py_ts(x):
    try:
        return dt.datetime.strptime(x, "%Y-%m-%dT%H:%M:%S.%fZ")
    except (TypeError, ValueError):
        return None


def test_parse_event_ts_matches_strptime(spark):
    xs = [ts_text() for _ in range(5000)] + [None, "", "2026-02-29T00:00:00.0Z", "2024-02-29T00:00:00.0Z"]
    got = spark.createDataFrame([(x,) for x in xs], "x string").select(
        "x", parse_event_ts("x").alias("t")).collect()
    bad = [(r.x, r.t, py_ts(r.x)) for r in got if r.t != py_ts(r.x)]
    assert not bad, bad[:10]


def canonical_ts_text():
    """The writer's shape with any digits, so impossible fields (month 00 or 13+, day
    00 or past the month's end, hour 24+, second 60+, year 0000) are drawn too."""
    d = lambda n: "".join(RND.choice("0123456789") for _ in range(n))
    year = RND.choice(["0000", "0001", "1999", "2024", "9999", d(4)])
    month = RND.choice([f"{RND.randint(0, 19):02d}", f"{RND.randint(1, 12):02d}"])
    day = RND.choice([f"{RND.randint(0, 39):02d}", f"{RND.randint(28, 31):02d}"])
    return (f"{year}-{month}-{day}T{RND.randint(0, 29):02d}:{RND.randint(0, 69):02d}:"
            f"{RND.randint(0, 69):02d}.{d(3)}Z")


def test_parse_event_ts_writer_shape_matches_strptime(spark):
    xs = [canonical_ts_text() for _ in range(5000)] + ["0000-01-01T00:00:00.000Z", "2024-02-29T23:59:59.999Z"]
    got = spark.createDataFrame([(x,) for x in xs], "x string").select(
        "x", parse_event_ts("x").alias("t")).collect()
    bad = [(r.x, r.t, py_ts(r.x)) for r in got if r.t != py_ts(r.x)]
    assert not bad, bad[:10]
    assert sum(r.t is not None for r in got) > 500


def test_strip_ws_matches_python_strip(spark):
    from usagelens.functions import strip_ws

    pool = [c for c in map(chr, range(0x3001)) if c.isspace()] + list("ab{}\" é€") + ["​", "﻿"]
    xs = ["".join(RND.choice(pool) for _ in range(RND.randint(0, 8))) for _ in range(3000)]
    got = spark.createDataFrame([(x,) for x in xs], "x string").select("x", strip_ws("x").alias("y")).collect()
    bad = [(r.x, r.y) for r in got if r.y != r.x.strip()]
    assert not bad, bad[:10]


def test_plain_numerals_match_python(spark):
    """Text in the forms the fast paths take: plain integers and decimals,
    scientific forms, signs and leading zeros (which the fast path hands on)."""
    ints = [str(RND.randint(-2**40, 2**40)) for _ in range(1500)] + ["0", "-0", "007", "+5", "2147483647", "2147483648"]
    floats = [repr(RND.uniform(-1e6, 1e6)) for _ in range(1500)] + [repr(RND.random() * 10 ** RND.randint(-12, 12))
                                                                   for _ in range(1500)]
    floats += ["1.0E-4", "1.0e-4", "Infinity", "-Infinity", "NaN", "12.50", "0.1", "1e3"]
    xs = ints + floats
    got = spark.createDataFrame([(x,) for x in xs], "x string").select(
        "x", safe_float("x").alias("f"), safe_int("x").alias("i")).collect()
    bad = []
    for r in got:
        f = py_float(r.x)
        same_f = (math.isnan(f) and r.f is not None and math.isnan(r.f)) or r.f == f
        if not same_f or r.i != py_int(r.x):
            bad.append((r.x, r.f, r.i, f, py_int(r.x)))
    assert not bad, bad[:10]
