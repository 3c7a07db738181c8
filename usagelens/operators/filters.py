"""The page's filters as Column predicates (never spliced into SQL text).

* attribute picks (practice, level, location, model): ``None`` is the page default
  (every option selected), which admits every non-NULL value; a list admits its
  values; an empty list admits nothing.
* date range: ``timestamp BETWEEN start AND end`` where both dates widen to
  midnight, so by default the rest of the end day is left out, as on the page;
  ``end_day="whole"`` keeps the whole end day.
* tables stored with an ``event_date`` partition column also get the same range
  on that column, so the scan skips whole days (Spark cannot derive it from the
  timestamp predicate by itself).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DateLike = dt.date | str


def _pick(col: Column, values: Sequence[str] | None) -> Column:
    if values is None:
        return col.isNotNull()
    if len(values) == 0:
        return F.lit(False)
    return col.isin(list(values))


def _midnight(d: dt.date) -> Column:
    """Zone-less midnight of a day, from text (no session time zone involved)."""
    return F.lit(f"{d.isoformat()} 00:00:00").cast("timestamp_ntz")


def _as_date(d: DateLike) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


@dataclass(frozen=True)
class UsageFilters:
    practices: tuple[str, ...] | None = None
    levels: tuple[str, ...] | None = None
    locations: tuple[str, ...] | None = None
    models: tuple[str, ...] | None = None
    start: DateLike | None = None
    end: DateLike | None = None
    end_day: str = "midnight"

    def __post_init__(self):
        if self.end_day not in ("midnight", "whole"):
            raise ValueError("end_day must be 'midnight' or 'whole'")
        for name in ("practices", "levels", "locations", "models"):
            v = getattr(self, name)
            if v is not None and not isinstance(v, tuple):
                object.__setattr__(self, name, tuple(v))

    # -- predicates -------------------------------------------------------
    def employee_predicate(self, prefix: str = "") -> Column:
        return (
            _pick(F.col(prefix + "practice"), self.practices)
            & _pick(F.col(prefix + "level"), self.levels)
            & _pick(F.col(prefix + "location"), self.locations)
        )

    def model_predicate(self, column: str = "model") -> Column:
        return _pick(F.col(column), self.models)

    def time_predicate(self, df: DataFrame, column: str = "timestamp") -> Column:
        if self.start is None or self.end is None:
            raise ValueError("date range unresolved: call with_page_dates() first")
        start, end = _as_date(self.start), _as_date(self.end)
        ts = F.col(column)
        lo = _midnight(start)
        if self.end_day == "midnight":
            pred = ts.between(lo, _midnight(end))
        else:
            pred = (ts >= lo) & (ts < _midnight(end + dt.timedelta(days=1)))
        if "event_date" in df.columns:
            pred = pred & F.col("event_date").between(F.lit(start), F.lit(end))
        return pred

    def day_predicate(self, day: str, midnight: str) -> Column:
        """``time_predicate`` for rows that know their day and whether they are of its midnight."""
        if self.start is None or self.end is None:
            raise ValueError("date range unresolved: call with_page_dates() first")
        start, end = F.lit(_as_date(self.start)), F.lit(_as_date(self.end))
        pred = F.col(day).between(start, end)
        return pred if self.end_day == "whole" else pred & ((F.col(day) < end) | F.col(midnight))

    # -- defaults -----------------------------------------------------------
    def with_days(self, first: DateLike, last: DateLike) -> "UsageFilters":
        """Fill an unset start/end with known days."""
        return replace(self, start=self.start if self.start is not None else first,
                       end=self.end if self.end is not None else last)

    def with_page_dates(self, bounds: DataFrame) -> "UsageFilters":
        """Fill an unset start/end from ``date_bounds`` (one row), as the page does."""
        if self.start is not None and self.end is not None:
            return self
        row = bounds.collect()[0]   # an ungrouped aggregate: exactly one row
        return replace(
            self,
            start=self.start if self.start is not None else row["min_date"],
            end=self.end if self.end is not None else row["max_date"],
        )


def date_bounds(api_requests: DataFrame) -> DataFrame:
    """first and last day with an API request (``MIN/MAX(timestamp)::DATE``)."""
    if "event_date" in api_requests.columns:
        # Same answer from the partition column (NULL when the timestamp is NULL):
        # the scan reads no data columns.
        return api_requests.select("event_date").agg(F.min("event_date").alias("min_date"), F.max("event_date").alias("max_date"))
    return api_requests.agg(
        F.to_date(F.min("timestamp")).alias("min_date"),
        F.to_date(F.max("timestamp")).alias("max_date"),
    )


def filter_options(employees: DataFrame, api_requests: DataFrame) -> DataFrame:
    """the option lists of the four pickers as (option, value) rows, each sorted.

    The three employee lists come from one pass over the dimension; the distinct is a
    partial aggregate per task, then a shuffle of at most one row per value and task."""
    picks = F.inline(F.array(*[F.struct(F.lit(c).alias("option"), F.col(c).alias("value"))
                               for c in ("practice", "level", "location")]))
    models = api_requests.select(F.lit("model").alias("option"), F.col("model").alias("value"))
    return employees.select(picks).unionByName(models).distinct().orderBy("option", F.col("value").asc_nulls_last())
