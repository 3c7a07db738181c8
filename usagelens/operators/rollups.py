"""The page's analytical queries, as DataFrame plans over ``UsageTables``.

Result columns, group keys and limits are fixed values of the page. Numeric rules, the
same for every join shape and restated by the DuckDB oracle:

* costs of any size are summed exactly, in any order (``operators/costs.py``);
* a NaN or infinite cost makes its group's sum and average NaN or infinite;
* sums are rounded half-up; averages and percentages are rounded half-up once, from
  integers, never by dividing decimals;
* token counts and their sums are BIGINT;
* every LIMIT breaks ties on the group keys, so the cut is deterministic.
"""

from __future__ import annotations

from functools import cached_property
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelens.functions.labels import error_label, heatmap_day_order, model_short_name, weekday_name
from usagelens.operators.costs import BinnedCosts, PlainCosts, half_up_quotient, measure_costs
from usagelens.operators.filters import UsageFilters, date_bounds
from usagelens.operators.mailfilter import MailFilter, build_mail_filter
from usagelens.operators.star import DEFAULT_LIMIT_BYTES, broadcast_allowed, join_employees
from usagelens.session import stage_table
from usagelens.tables import UsageTables


def tokens() -> Column:
    return F.col("input_tokens").cast("long") + F.col("output_tokens").cast("long")


# Additive parts shared by the queries (summed after the join).
def p_n() -> Column:
    return F.lit(1).cast("long")


def p_tokens_n() -> Column:
    return F.when(tokens().isNotNull(), F.lit(1)).cast("long")


def p_success() -> Column:
    return F.when(F.col("success"), F.lit(1)).otherwise(F.lit(0)).cast("long")


HOURS = list(range(24))
# Hash buckets of error messages that one task counts (``top_errors_free_text``).
ERROR_BUCKETS = 1 << 16


def percent_1dp(hits: str, total: str) -> Column:
    """``ROUND(100.0 * hits / total, 1)``, half-up, in exact integer arithmetic."""
    return F.expr(f"cast((2000 * {hits} + {total}) div (2 * {total}) as double) / 10")


class UsagePage:
    """One page state: the tables, resolved filters and the chosen join shape.

    Building it runs two small jobs: the date bounds (when the range is unset and the
    source does not know its days) and the size check of the employee dimension. The first
    query that sums costs runs a third (``costs``).
    """

    def __init__(
        self,
        tables: UsageTables,
        filters: UsageFilters | None = None,
        broadcast_limit_bytes: int = DEFAULT_LIMIT_BYTES,
        broadcast: bool | None = None,
    ):
        self.tables = tables
        filters = filters or UsageFilters()
        if tables.days:
            filters = filters.with_days(*tables.days)
        self.filters = filters.with_page_dates(date_bounds(tables.api_requests))
        if broadcast is None:
            broadcast = broadcast_allowed(tables.employees, broadcast_limit_bytes)
        self.broadcast = broadcast
        self._base: DataFrame | None = None

    # -- one scan for the whole page -----------------------------------------
    BASE_GRAIN = ("session_id", "model", "day", "hour")

    @cached_property
    def costs(self) -> PlainCosts | BinnedCosts:
        """How this page's costs are summed: one small job over one column, when first needed."""
        return measure_costs(self._requests())

    @cached_property
    def mail_filter(self) -> MailFilter | None:
        """The picked employees' emails for the fact scans; None where the dimension is
        broadcast, nothing is picked, or the picks keep most of it."""
        f = self.filters
        if self.broadcast or (f.practices is None and f.levels is None and f.locations is None):
            return None
        return build_mail_filter(self.tables.employees, f.employee_predicate())

    def _requests(self) -> DataFrame:
        facts = self.tables.api_requests
        return facts.where(self.filters.time_predicate(facts) & self.filters.model_predicate())

    def share(self) -> "UsagePage":
        """Scan and filter the API requests once for every request rollup of the page.

        The facts are aggregated to ``(user_email, session_id, model, day, hour)``
        with additive parts and persisted; each rollup then reads that (much
        smaller) frame instead of the fact table. Exact: every rollup's grain is
        a function of this grain and every part is a sum. ``unshare()`` frees it."""
        if self._base is None:
            parts = {"n": p_n(), **self.costs.parts(), "tokens": tokens(), "tokens_n": p_tokens_n()}
            self._base = (
                self.costs.prepare(self._requests()).groupBy("user_email", "session_id", "model",
                              F.to_date("timestamp").alias("day"), F.hour("timestamp").alias("hour"))
                .agg(*[F.sum(c).alias(n) for n, c in parts.items()])
                .persist()
            )
        return self

    def use_base(self, base: DataFrame, costs: PlainCosts | BinnedCosts) -> "UsagePage":
        """Let the request rollups read ``base``: filtered rows of ``share``'s grain and parts,
        kept elsewhere (``sources/parts.py``), with costs of this form."""
        self._base, self.costs = base, costs
        return self

    def unshare(self) -> None:
        if self._base is not None:
            self._base.unpersist()
            self._base = None

    def _from_base(self, grain: Mapping[str, Column], parts: Mapping[str, Column]):
        derived = {"dow": F.dayofweek("day")}
        g = {name: derived.get(name, F.col(name)) for name in grain}
        unknown = [n for n in grain if n not in self.BASE_GRAIN and n not in derived]
        unknown += [n for n in parts if n not in ("n", *self.costs.names, "tokens", "tokens_n")]
        if unknown:
            raise ValueError(f"not derivable from the shared base: {unknown}")
        return self._base, g, {n: F.col(n) for n in parts}

    # -- the shared join -----------------------------------------------------
    def joined(
        self,
        fact: str,
        grain: Mapping[str, Column],
        parts: Mapping[str, Column],
        employee_columns: Sequence[str] = (),
        model_filter: bool = True,
        extra: Column | None = None,
        keep: Callable[[DataFrame], DataFrame] | None = None,
    ) -> DataFrame:
        f = self.filters
        if self._base is not None and fact == "api_requests" and model_filter and extra is None:
            facts, grain, parts = self._from_base(grain, parts)
        else:
            facts = self.tables.fact(fact)
            pred = f.time_predicate(facts)
            if model_filter:
                pred = pred & f.model_predicate()
            if extra is not None:
                pred = extra & pred
            facts = facts.where(pred)
            if "cost_n" in parts:
                facts = self.costs.prepare(facts)
        if self.mail_filter is not None:
            facts = facts.where(self.mail_filter.passes("user_email"))
        if keep is not None:
            facts = keep(facts)
        if grain:
            facts = facts.withColumns(dict(grain))
        emp = self.tables.employees.where(f.employee_predicate())
        return join_employees(facts, emp, list(grain), parts, employee_columns, self.broadcast).frame

    # -- Q1 ------------------------------------------------------------------
    def kpi(self, approx_distinct: bool = False) -> DataFrame:
        """Q1. ``approx_distinct`` counts sessions and users with HyperLogLog++
        (about 2% error, fixed memory) instead of exact distinct counts."""
        distinct = F.approx_count_distinct if approx_distinct else F.count_distinct
        sums = {"n": p_n(), **self.costs.parts(), "tokens": tokens()}
        heads = {"total_sessions": distinct("session_id"), "active_users": distinct("user_email")}
        totals = {"total_api_calls": F.coalesce(F.sum("n"), F.lit(0).cast("long")), "total_cost": self.costs.money(),
                  "avg_cost_per_call": self.costs.average(4), "total_tokens": F.sum("tokens")}
        session = {"session_id": F.col("session_id")}
        if isinstance(self.costs, BinnedCosts) and self._base is None:
            # Dozens of sums: not grouped and expanded with the distinct counts, which have a scan of two columns.
            total = self.joined("api_requests", {}, sums).agg(*[c.alias(n) for n, c in totals.items()])
            j = self.joined("api_requests", session, {"n": p_n()}).groupBy("user_email", "session_id").agg(F.sum("n").alias("n"))
            row = total.crossJoin(j.agg(*[c.alias(n) for n, c in heads.items()]))
        else:
            # One row per (user, session) first: the distinct counts then expand few rows.
            j = self.joined("api_requests", session, sums).groupBy("user_email", "session_id").agg(*[F.sum(c).alias(c) for c in sums])
            row = j.agg(*[c.alias(n) for n, c in {**heads, **totals}.items()])
        return row.select("total_sessions", *totals, "active_users")

    # -- Q2 ------------------------------------------------------------------
    def model_usage(self, prefix: str | None = None) -> DataFrame:
        j = self.joined("api_requests", {"model": F.col("model")}, {"n": p_n(), **self.costs.parts()})
        out = j.groupBy("model").agg(
            F.sum("n").alias("api_calls"), self.costs.money().alias("total_cost")
        )
        short = model_short_name("model") if prefix is None else model_short_name("model", prefix)
        return out.withColumn("model_short", short).orderBy(
            F.desc("api_calls"), F.col("model").asc_nulls_last()
        )

    # -- Q3 / Q4 -------------------------------------------------------------
    def _practice_costs(self) -> DataFrame:
        j = self.joined("api_requests", {}, {"n": p_n(), **self.costs.parts()}, ["practice"])
        return j.groupBy("practice").agg(self.costs.money().alias("total_cost"), F.sum("n").alias("api_calls"))

    def cost_by_practice(self) -> DataFrame:
        return self._practice_costs().orderBy(F.desc_nulls_last("total_cost"), F.col("practice").asc_nulls_last())

    def cost_share(self) -> DataFrame:
        """Each practice's part of the total (the ring chart), over the few rolled-up
        rows: the window spans one row per practice, never fact rows."""
        total = F.sum("total_cost").over(Window.partitionBy())
        return (self._practice_costs().withColumn("cost_share", F.round(F.col("total_cost") / total, 6))
                .orderBy(F.desc_nulls_last("total_cost"), F.col("practice").asc_nulls_last()))

    # -- Q5 ------------------------------------------------------------------
    def daily_usage(self) -> DataFrame:
        j = self.joined("api_requests", {"day": F.to_date("timestamp")}, {"n": p_n(), **self.costs.parts()})
        return j.groupBy("day").agg(
            F.sum("n").alias("api_calls"), self.costs.money().alias("daily_cost")
        ).orderBy("day")

    # -- Q6 / Q7 -------------------------------------------------------------
    def hour_dow(self) -> DataFrame:
        j = self.joined(
            "api_requests", {"hour": F.hour("timestamp"), "dow": F.dayofweek("timestamp")}, {"n": p_n()}
        )
        return j.groupBy("hour", "dow").agg(F.sum("n").alias("calls"))

    def usage_heatmap(self) -> DataFrame:
        """Weekday rows (Mon..Sun, only days that occur) x 24 hour columns, 0-filled."""
        hd = self.hour_dow()
        wide = hd.groupBy("dow").pivot("hour", HOURS).agg(F.sum("calls"))
        cells = [F.coalesce(F.col(str(h)), F.lit(0).cast("long")).alias(f"h{h:02d}") for h in HOURS]
        return wide.select(
            heatmap_day_order("dow").alias("day_order"), weekday_name("dow").alias("day_name"), *cells
        ).orderBy("day_order")

    # -- Q8 ------------------------------------------------------------------
    def tokens_by_level(self, level_order: str = "text") -> DataFrame:
        """Q8. Levels sort as text (L1, L10, L2) as on the page; ``level_order=
        "numeric"`` sorts by the number after the letter instead."""
        j = self.joined(
            "api_requests", {},
            {"tokens": tokens(), "tokens_n": p_tokens_n(), **self.costs.parts()},
            ["level"],
        )
        out = j.groupBy("level").agg(
            half_up_quotient(F.sum("tokens"), F.sum("tokens_n"), 0).alias("avg_tokens"),
            self.costs.average(5).alias("avg_cost"),
        )
        if level_order == "numeric":
            num = F.regexp_extract("level", r"(\d+)", 1).try_cast("int")
            return out.orderBy(num.asc_nulls_last(), F.col("level").asc_nulls_last())
        return out.orderBy(F.col("level").asc_nulls_last())

    # -- Q9 ------------------------------------------------------------------
    def tool_success(self, top: int = 12) -> DataFrame:
        j = self.joined(
            "tool_events", {"tool_name": F.col("tool_name")}, {"n": p_n(), "ok": p_success()},
            model_filter=False, extra=F.col("event_type") == "result",
        )
        return (
            j.groupBy("tool_name").agg(F.sum("n").alias("uses"), F.sum("ok").alias("ok"))
            .select("tool_name", "uses", percent_1dp("ok", "uses").alias("success_rate"))
            .orderBy(F.desc("uses"), F.col("tool_name").asc_nulls_last())
            .limit(top)
        )

    # -- Q10 / Q13 -----------------------------------------------------------
    def top_errors(self, top: int = 10, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        j = self.joined(
            "api_errors", {"model": F.col("model"), "error_message": F.col("error_message")},
            {"n": p_n()}, model_filter=False, keep=keep,
        )
        return (
            j.groupBy("model", "error_message").agg(F.sum("n").alias("occurrences"))
            .orderBy(F.desc("occurrences"), F.col("model").asc_nulls_last(),
                     F.col("error_message").asc_nulls_last())
            .limit(top)
        )

    def top_errors_free_text(self, top: int = 10, buckets: int = ERROR_BUCKETS) -> DataFrame:
        """``top_errors`` where messages are free text (request ids, times), so that nearly every
        row is a group of its own: the same rows without shuffling a group per message.

        1. Rows are counted per hash bucket of (model, message): at most ``buckets`` rows leave a
           task. A group's count is at most its bucket's.
        2. The groups of the fullest ``4 * top`` buckets are counted exactly; the count at place ``top``
           is a floor (0 if there are fewer groups).
        3. A group that reaches the floor lies in a bucket that does: the groups of those
           buckets alone are counted exactly, and the top of them is the answer, ties included.

        Three scans; how many groups step 3 counts falls with the share of the top messages. With
        no frequent message at all every bucket passes, and step 3 is ``top_errors``."""
        facts = self.tables.api_errors
        facts = facts.where(self.filters.time_predicate(facts))
        if self.mail_filter is not None:
            facts = facts.where(self.mail_filter.passes("user_email"))
        bucket = F.pmod(F.xxhash64("model", "error_message"), F.lit(buckets))
        # An upper bound: employees that the join leaves out only lower a group's count.
        most = stage_table(facts.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("most")), "error-buckets")

        def within(chosen: DataFrame) -> Callable[[DataFrame], DataFrame]:
            listed = F.broadcast(chosen.select(F.col("bucket").alias("listed")))  # at most ``buckets`` rows
            return lambda rows: rows.join(listed, bucket == F.col("listed"), "left_semi")

        fullest = most.orderBy(F.desc("most"), "bucket").limit(4 * top)
        last = self.top_errors(top, within(fullest)).agg(F.min("occurrences").alias("least"), F.count(F.lit(1)).alias("n")).first()
        floor = last["least"] if last["n"] == top else 0
        return self.top_errors(top, within(most.where(F.col("most") >= floor)))

    def error_label_totals(self, top: int = 10) -> DataFrame:
        """The top errors with their bar label and the label's summed length, which
        orders the bars ("total ascending"); a label can span several models."""
        top_rows = self.top_errors(top).withColumn("label", error_label("error_message"))
        per_label = Window.partitionBy("label")
        return top_rows.withColumn("label_total", F.sum("occurrences").over(per_label)).orderBy(
            "label_total", "label", "model"
        )

    # -- Q11 -----------------------------------------------------------------
    def cost_by_location(self) -> DataFrame:
        j = self.joined("api_requests", {}, {"n": p_n(), **self.costs.parts()}, ["location"])
        return j.groupBy("location").agg(
            self.costs.money().alias("total_cost"),
            F.count_distinct("email").alias("engineers"),
            F.sum("n").alias("api_calls"),
        ).orderBy(F.desc_nulls_last("total_cost"), F.col("location").asc_nulls_last())

    # -- Q12 -----------------------------------------------------------------
    def top_engineers(self, top: int = 20) -> DataFrame:
        keys = ["full_name", "practice", "level", "location"]
        j = self.joined(
            "api_requests", {"session_id": F.col("session_id")},
            {"n": p_n(), **self.costs.parts(), "tokens": tokens()}, keys,
        )
        return (
            j.groupBy(*keys).agg(
                F.count_distinct("session_id").alias("sessions"),
                F.sum("n").alias("api_calls"),
                self.costs.money().alias("total_cost"),
                F.sum("tokens").alias("total_tokens"),
            )
            .orderBy(F.desc_nulls_last("total_cost"), *[F.col(k).asc_nulls_last() for k in keys])
            .limit(top)
        )
