"""Display helpers the page applies to rolled-up results, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values the page uses: the vendor prefix dropped from model names, the date
# suffix pattern dropped after it, the label cut for error messages and its marker,
# and the weekday names for Spark's dayofweek numbers 1..7 (Sunday first).
MODEL_PREFIX = "claude-"
MODEL_DATE_SUFFIX = r"-2025\d+"
ERROR_LABEL_CHARS = 45
ERROR_LABEL_MARK = "..."
WEEKDAY_NAMES = {1: "Sun", 2: "Mon", 3: "Tue", 4: "Wed", 5: "Thu", 6: "Fri", 7: "Sat"}


def model_short_name(model: Column | str, prefix: str = MODEL_PREFIX) -> Column:
    """Drop every ``prefix`` and every ``-2025<digits>`` from a model name."""
    c = F.col(model) if isinstance(model, str) else model
    return F.regexp_replace(F.replace(c, F.lit(prefix), F.lit("")), MODEL_DATE_SUFFIX, "")


def error_label(message: Column | str) -> Column:
    """First 45 characters plus ``...`` (always added); NULL stays NULL."""
    c = F.col(message) if isinstance(message, str) else message
    return F.concat(F.substring(c, 1, ERROR_LABEL_CHARS), F.lit(ERROR_LABEL_MARK))


def weekday_name(dow: Column | str) -> Column:
    """Spark ``dayofweek`` number (1 = Sunday) to its short name; unknown -> NULL."""
    c = F.col(dow) if isinstance(dow, str) else dow
    pairs = [x for k, v in WEEKDAY_NAMES.items() for x in (F.lit(k), F.lit(v))]
    return F.element_at(F.create_map(*pairs), c)


def heatmap_day_order(dow: Column | str) -> Column:
    """Row position of a weekday in the heatmap: Monday 1 .. Sunday 7."""
    c = F.col(dow) if isinstance(dow, str) else dow
    return ((c + F.lit(5)) % F.lit(7) + F.lit(1)).cast("int")


def pseudonym(email: Column | str) -> Column:
    """Stable user id from an email: SHA-256 hex of its UTF-8 text."""
    c = F.col(email) if isinstance(email, str) else email
    return F.sha2(c, 256)
