"""Fact ⋈ employees, the join under every page query.

Two physical shapes, chosen by a measured size of the (filtered) dimension:

* **broadcast** (dimension within ``limit_bytes``): each fact row is narrowed to the
  grain columns and its additive parts, joined map-side against the broadcast
  dimension, then aggregated (partial aggregate per task, one shuffle of the
  partial rows on the output keys). No shuffle of fact rows at all.
* **shuffle** (dimension too large to ship): the facts are first aggregated to
  one row per ``(user_email, grain...)`` — the map-side partial aggregate
  collapses a hot user to one row per task before anything moves — then joined
  to the dimension on ``email`` with a shuffle join (AQE splits a skewed key).

Callers describe the work as additive *parts* (a count is ``lit(1)``, a sum its
value) and aggregate the joined rows with ``sum(part)``: the final aggregate is the
same expression on either shape, so both give the same numbers.

Two things spare the shuffle shape work: facts and dimension stored in buckets
(``sources/buckets.py``) need no shuffle on either side, and a filter of the picked emails
(``operators/mailfilter.py``) drops the other employees' rows before the aggregate.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_LIMIT_BYTES = 128 * 1024 * 1024
# Per-row overhead added to the payload bytes when sizing a broadcast: the row
# header and string offsets of Spark's row format, plus hash-table slots.
_ROW_OVERHEAD = 64
# Tables stored in buckets (``sources/buckets.py``) cut a hot email into several by this column.
SALT = "bucket_salt"


def dimension_bytes(employees: DataFrame) -> int:
    """Exact payload size of the dimension: one aggregate job, no rows to the driver."""
    cols = [c for c, t in employees.dtypes if t == "string"]
    payload = sum((F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in cols), F.lit(0).cast("long"))
    row = employees.agg(F.count(F.lit(1)).alias("n"), F.sum(payload).alias("b")).collect()[0]
    return int(row["b"] or 0) + int(row["n"]) * _ROW_OVERHEAD


def broadcast_allowed(employees: DataFrame, limit_bytes: int = DEFAULT_LIMIT_BYTES) -> bool:
    """True when the whole dimension, measured now, fits the limit; filters only shrink
    what is shipped."""
    return limit_bytes > 0 and dimension_bytes(employees) <= limit_bytes


@dataclass(frozen=True)
class StarJoin:
    """The joined rows of one query: grain columns, additive parts, employee columns."""

    frame: DataFrame
    broadcast: bool


def join_employees(
    facts: DataFrame,
    employees: DataFrame,
    grain: Sequence[str],
    parts: Mapping[str, Column],
    employee_columns: Sequence[str],
    broadcast: bool,
) -> StarJoin:
    """Join filtered facts to the filtered dimension at ``(user_email, *grain)``.

    ``parts`` are per-row additive values; the result has one column per part that
    the caller sums. ``employee_columns`` are the dimension columns kept (``email``
    is always kept).
    """
    emp_cols = ["email"] + [c for c in employee_columns if c != "email"]
    keys = ["user_email"] + [g for g in grain if g != "user_email"]
    salt = [SALT] if SALT in facts.columns and SALT in employees.columns else []
    if SALT in employees.columns and not salt:
        employees = employees.where(F.col(SALT) == 0)  # one row per email
    dim = employees.select(*emp_cols, *[F.col(s).alias(f"dim_{s}") for s in salt])
    if broadcast:
        left, right = facts.select(*keys, *salt, *[c.alias(n) for n, c in parts.items()]), F.broadcast(dim)
    else:
        left = facts.groupBy(*keys, *salt).agg(*[F.sum(c).alias(n) for n, c in parts.items()])
        # Our measure said the dimension is too big to ship: keep Spark's planner
        # from broadcasting it on a smaller estimate. Sort-merge needs no hash table
        # of the dimension side, and AQE splits a skewed partition.
        right = dim.hint("merge")
    on = [F.col("user_email") == F.col("email")] + [F.col(s) == F.col(f"dim_{s}") for s in salt]
    joined = left.join(right, on, "inner")
    return StarJoin(joined.select(*keys, *parts.keys(), *emp_cols), broadcast)
