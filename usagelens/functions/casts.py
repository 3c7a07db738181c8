"""Guarded casts of attribute text, as JVM column expressions (no Python UDF).

Each helper gives the value the reference's Python helper would give, and the
documented default where that helper falls back (or would stop with an error).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text forms Python's float() accepts (underscores between digits),
# and the pieces of the "%Y-%m-%dT%H:%M:%S.%fZ" format as strptime matches them
# (field widths, a leading blank allowed in the day, letters matched case-blind).
_DIGITS = r"\d(?:_?\d)*"
_NUMBER = rf"[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
_SPECIAL = r"[+-]?(?i:inf|infinity|nan)"
_TS_PATTERN = (
    r"^(\d{4})-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12]\d|0[1-9]|[1-9]| [1-9])"
    r"[Tt](2[0-3]|[01]\d|\d):([0-5]\d|\d):([0-5]\d|\d)\.(\d{1,6})[Zz]$"
)
# The writer's form with every digit shown as '#'.
_TS_CANONICAL = "####-##-##T##:##:##.###Z"


# The characters Python's str.isspace() accepts, which str.strip()
# removes: U+0009-U+000D, U+001C-U+001F, U+0020, U+0085, U+00A0, U+1680,
# U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip_ws(c: Column | str) -> Column:
    """Python ``str.strip()``: drop leading and trailing whitespace of any kind.

    ``btrim`` with a character set walks in from both ends only (no regex over the
    whole text, which matters for long log lines)."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def lookup(m: Column | str, key: str, default: str | None = "") -> Column:
    """``d.get(key, default)`` on a string map: absent key -> default, JSON null -> NULL."""
    m = _col(m)
    # One scan of the map for a present, non-NULL value; the key test only runs
    # when the value is NULL (absent key or JSON null).
    return F.coalesce(
        F.element_at(m, F.lit(key)),
        F.when(~F.coalesce(F.map_contains_key(m, F.lit(key)), F.lit(False)), F.lit(default)),
    )


def safe_float(c: Column | str, default: float = 0.0) -> Column:
    """``float(x)`` with a default for text Python rejects (``12d``, ``0x10``, empty, NULL).

    One regex gates the text (surrounding whitespace allowed); Spark's cast trims it."""
    c = _col(c)
    d = c.try_cast("double")
    ok = c.rlike(rf"^\s*({_NUMBER}|{_SPECIAL})\s*$")
    # Spark's cast knows "nan" but not a signed one; Python takes "+nan" / "-nan".
    nan = c.rlike(r"^\s*[+-]?(?i:nan)\s*$")
    number = F.translate(c, "_", "").try_cast("double")
    general = F.coalesce(F.when(nan, F.lit(float("nan"))).when(ok, number), F.lit(default).cast("double"))
    # Text that is exactly Spark's own rendering of its value ("12.5", "1.0E-4") is
    # a numeral Python reads to the same double: no regex needed.
    return F.when(d.cast("string") == c, d).otherwise(general)


def safe_int(c: Column | str, default: int = 0) -> Column:
    """``int(float(x))`` as BIGINT: truncates toward zero; NaN, infinity, non-numbers and
    values beyond 64 bits give the default."""
    c = _col(c)
    i = c.try_cast("bigint")
    as_double = F.when(c.rlike(rf"^\s*{_NUMBER}\s*$"), F.translate(c, "_", "").try_cast("double"))
    general = F.coalesce(as_double.try_cast("bigint"), F.lit(default).cast("bigint"))
    # Plain integer text ("1234", "-7": Spark's own rendering of the value) needs no
    # regex, as long as a double holds it exactly.
    return F.when((i.cast("string") == c) & i.between(-(1 << 53), 1 << 53), i).otherwise(general)


def safe_bool(c: Column | str) -> Column:
    """``str(x).lower() == 'true'``; absent or NULL is false."""
    return F.coalesce(F.lower(_col(c)) == F.lit("true"), F.lit(False))


def parse_event_ts(c: Column | str) -> Column:
    """``strptime(x, '%Y-%m-%dT%H:%M:%S.%fZ')`` as TIMESTAMP_NTZ, NULL when it fails
    (wrong shape, impossible date such as Feb 30, missing fraction, offset suffix).

    The writer's own form (``2026-01-31T12:00:00.123Z``: fixed field widths,
    millisecond fraction) is told apart without a regex and read by Spark's cast,
    which accepts and rejects the same dates as ``strptime`` for that shape (year 0
    excepted, hence the guard). Any other text takes the general path: one regex
    checks the shape and the seven fields come from one split."""
    c = _col(c)
    canonical = (F.translate(c, "0123456789", "##########") == F.lit(_TS_CANONICAL)) & (
        F.substring(c, 1, 4) != F.lit("0000")
    )
    parts = F.split(c, "[-Tt:.Zz]")
    part = lambda i: F.trim(parts.getItem(i))
    seconds = F.concat(part(5), F.lit("."), part(6)).cast("decimal(8,6)")
    year = part(0).cast("int")
    ts = F.try_make_timestamp_ntz(
        year, part(1).cast("int"), part(2).cast("int"),
        part(3).cast("int"), part(4).cast("int"), seconds,
    )
    general = F.when(c.rlike(_TS_PATTERN) & (year >= 1), ts)   # Python's datetime starts at year 1
    return F.when(canonical, F.substring(c, 1, 23).try_cast("timestamp_ntz")).otherwise(general)


def format_event_ts(c: Column | str) -> Column:
    """Event time as the writer prints it: ISO text with milliseconds (truncated) and
    ``Z``. Built from the zone-less text form, so no session time zone is involved."""
    text = _col(c).cast("timestamp_ntz").cast("string")   # yyyy-MM-dd HH:mm:ss[.f...]
    whole = F.regexp_extract(text, r"^([^.]*)", 1)
    frac = F.regexp_extract(text, r"\.(\d+)$", 1)
    ms = F.substring(F.rpad(frac, 3, "0"), 1, 3)
    return F.concat(F.replace(whole, F.lit(" "), F.lit("T")), F.lit("."), ms, F.lit("Z"))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c

