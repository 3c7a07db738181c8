"""Additive parts of the stored API requests, so that a page reads them and not the facts.

Layout::

    <root>/parts/event_date=<d>/load_id=<id>/part-*.parquet

One row per (user, session, model, hour, at midnight or not) of a day of a load, with the sums that every
request rollup of the page is made of. ``midnight`` tells the events at 00:00:00 of a day from the others,
for date ranges that stop at the end day's midnight. A load's parts have its ``load_id``, so a
replayed stream batch replaces them as it replaces its facts.

What counts is the pair (day, load): ``read_parts`` reads just those pairs that the facts hold now. ``fill_parts``
makes the pairs that are missing, whatever the reason: a load without parts, a job
stopped between facts and parts, a compaction (its merged folder is a new pair, the old ones are read no
more). Writing facts under a used ``load_id`` removes its parts first; no page may be read while a
load is being replaced that way. So parts never miss or repeat a fact, and can be made for a store at any time.

Cost sums are exact (``operators/costs.py``): ``cost`` where one decimal holds a load's costs, else ``bins``, the
nonzero (bin, sum) pairs; a page over loads of both kinds takes them together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.operators.costs import STEP, BinnedCosts, PlainCosts, fits_plain, measure_costs
from usagelens.operators.filters import UsageFilters
from usagelens.operators.rollups import UsagePage, p_n, p_tokens_n, tokens
from usagelens.sources.store import day_loads, facts_of, part_pairs, parts_path, stored_tables

TABLE = "api_requests"
PARTS = ("user_email string, session_id string, model string, hour int, midnight boolean, n bigint, tokens bigint, "
         "tokens_n bigint, cost decimal(38,15), cost_n bigint, odd_cost double, "
         "bins array<struct<bin:int,sum:decimal(38,0)>>, event_date date, load_id string")
COLUMNS = ("user_email", "session_id", "model", "hour", "midnight", "n", "tokens", "tokens_n", "cost", "cost_n", "odd_cost",
           "bins", "event_date", "load_id")
_WHOLE = "decimal(38,0)"


def request_parts(facts: DataFrame) -> DataFrame:
    """Requests (with ``event_date`` and ``load_id``) -> the rows of PARTS; measures the costs first."""
    costs = measure_costs(facts)
    sums = {"n": p_n(), **costs.parts(), "tokens": tokens(), "tokens_n": p_tokens_n()}
    midnight = F.col("timestamp") == F.date_trunc("day", "timestamp")
    rows = costs.prepare(facts).groupBy("user_email", "session_id", "model", F.hour("timestamp").alias("hour"),
                                        midnight.alias("midnight"), "event_date", "load_id").agg(
        *[F.sum(c).alias(n) for n, c in sums.items()])
    if isinstance(costs, BinnedCosts):
        pairs = F.array(*[F.struct(F.lit(costs.low + i).alias("bin"), F.coalesce(F.col(n), F.lit(0)).cast(_WHOLE).alias("sum"))
                          for i, n in enumerate(costs.bins)])
        rows = rows.withColumns({"cost": F.lit(None).cast("decimal(38,15)"), "bins": F.filter(pairs, lambda p: p["sum"] != 0)})
    else:
        rows = rows.withColumn("bins", F.lit(None).cast("array<struct<bin:int,sum:decimal(38,0)>>"))
    return rows.select(*COLUMNS)


def fill_parts(spark: SparkSession, root: str, load_id: str | None = None) -> int:
    """Make the parts of every stored (day, load) that has none, or all those of ``load_id`` anew;
    returns how many pairs. One job to measure costs, one to write."""
    todo = day_loads(spark, root, TABLE, load_id)
    if load_id is None:
        todo = sorted(set(todo) - set(part_pairs(spark, root)))
    if todo:
        rows = request_parts(facts_of(spark, root, TABLE, todo)).hint("rebalance", "event_date", "load_id")
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date", "load_id")
         .parquet(parts_path(root)))
    return len(todo)


def read_parts(spark: SparkSession, root: str) -> DataFrame:
    """The parts of what the facts hold now; missing ones are made first."""
    fill_parts(spark, root)
    base = parts_path(root)
    paths = [f"{base}/event_date={d}/load_id={i}" for d, i in day_loads(spark, root, TABLE)]
    if not paths:
        return spark.createDataFrame([], PARTS)
    return spark.read.schema(PARTS).option("basePath", base).parquet(*paths)


def _one_unit() -> Column:
    return F.lit(10 ** STEP).cast("decimal(16,0)")


def _plain_bin(k: int) -> Column:
    """What a DECIMAL(38,15) cost has in bin ``k``."""
    cost = F.coalesce("cost", F.lit(0).cast("decimal(38,15)"))
    fraction = cost % F.lit(1).cast("decimal(1,0)")
    whole = (cost - fraction).cast(_WHOLE)
    low = (whole % _one_unit()).cast(_WHOLE)
    if k == -1:
        return (fraction.cast("decimal(16,15)") * _one_unit()).cast(_WHOLE)
    return low if k == 0 else ((whole - low) / _one_unit()).cast(_WHOLE) if k == 1 else F.lit(0).cast(_WHOLE)


def _cost_form(parts: DataFrame) -> tuple[PlainCosts | BinnedCosts, DataFrame]:
    """How to sum the costs of these parts, and the parts with the columns it sums: one aggregate over two columns."""
    row = parts.agg(F.max(F.abs("cost")).cast("double").alias("most"), F.count("cost").alias("n"),
                    F.min(F.array_min("bins.bin")).alias("low"), F.max(F.array_max("bins.bin")).alias("high")).first()
    if row["low"] is None and fits_plain(row["most"], row["n"]):
        return PlainCosts(), parts
    costs = BinnedCosts(-1 if row["low"] is None else row["low"], max(row["high"] or 0, 1))

    def stored(k: int) -> Column:
        found = F.get(F.filter("bins", lambda b: b["bin"] == k), F.lit(0))["sum"]
        return (F.coalesce(found, F.lit(0).cast(_WHOLE)) + _plain_bin(k)).cast(_WHOLE)

    return costs, parts.withColumns({n: stored(costs.low + i) for i, n in enumerate(costs.bins)})


def stored_page(spark: SparkSession, root: str, filters: UsageFilters | None = None, **options) -> UsagePage:
    """The page over a store, its request rollups read from parts. Tool and error rollups read their facts."""
    page = UsagePage(stored_tables(spark, root), filters, **options)
    f = page.filters
    parts = read_parts(spark, root)
    costs, rows = _cost_form(parts.where(f.day_predicate("event_date", "midnight") & f.model_predicate()))
    return page.use_base(rows.withColumn("day", F.col("event_date")), costs)
