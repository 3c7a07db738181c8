"""Page parts kept with the store: the page over them equals the page over the facts."""

from dataclasses import replace

from conftest import SF_SMALL
from pyspark.sql import functions as F

from usagelens.operators.costs import BinnedCosts, PlainCosts
from usagelens.operators.envelopes import encode_facts, envelope_lines, pack_envelopes
from usagelens.operators.filters import UsageFilters, filter_options
from usagelens.operators.rollups import UsagePage
from usagelens.schemas import DECODED
from usagelens.sources import parts, store
from usagelens.sources.employees import write_employee_csv
from usagelens.sources.standin import standin_tables
from usagelens.streaming.incremental import run_incremental_load

ROLLUPS = ("kpi", "model_usage", "cost_by_practice", "cost_share", "daily_usage", "hour_dow", "usage_heatmap", "tokens_by_level",
           "cost_by_location", "top_engineers")
RANGES = (UsageFilters(), UsageFilters(start="2024-01-03", end="2024-01-09"),
          UsageFilters(start="2024-01-03", end="2024-01-09", end_day="whole"))


def rows(frame):
    return sorted(map(repr, map(tuple, frame.collect())))


def same_page(spark, root, filters, rollups=ROLLUPS):
    page, facts = parts.stored_page(spark, root, filters), UsagePage(store.stored_tables(spark, root), filters)
    for name in rollups:
        assert rows(getattr(page, name)()) == rows(getattr(facts, name)()), (name, filters)
    return page


def logs(spark, scratch):
    """Log lines with some events at a day's midnight, in several files."""
    t = standin_tables(spark, SF_SMALL)
    early = t.api_requests.withColumn("timestamp", F.when(F.crc32("event_id") % 3 == 0, F.date_trunc("day", "timestamp").cast(
        "timestamp_ntz")).otherwise(F.col("timestamp")))
    t = replace(t, api_requests=early)
    envelope_lines(pack_envelopes(encode_facts(t))).select("value").repartition(5).write.text(f"{scratch}/logs")
    write_employee_csv(t.employees, f"{scratch}/emp")
    store.append_employees(spark, f"{scratch}/db", f"{scratch}/emp")
    return f"{scratch}/logs", f"{scratch}/db"


def requests(spark, root, costs, load_id):
    """Store one request per cost, of two users and days."""
    emp = store.read_employees(spark, root).orderBy("email").limit(2).collect()
    data = [("api_request", f"e{i}", emp[i % 2].email, f"s{i % 3}", f"2024-01-{3 + i % 2:02d} 0{i % 2}:00:00", "m", c)
            for i, c in enumerate(costs)]
    frame = spark.createDataFrame(data, "kind string, event_id string, user_email string, session_id string, "
                                  "timestamp string, model string, cost_usd double").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    have = set(frame.columns)
    frame = frame.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in DECODED.fields],
                         *(["kind"] if "kind" not in DECODED.names else []))
    store.write_facts(frame, root, load_id)


def test_stream_restarted_twice_writes_parts(spark, scratch):
    src, root = logs(spark, scratch)
    run_incremental_load(spark, src, root, max_files_per_trigger=2, parts=True)
    assert store.part_pairs(spark, root) == store.day_loads(spark, root, "api_requests")
    run_incremental_load(spark, src, root, parts=True)
    assert parts.fill_parts(spark, root) == 0
    for filters in RANGES[:2]:
        same_page(spark, root, filters, ["kpi", "daily_usage"])
    page = same_page(spark, root, RANGES[2])
    assert isinstance(page.costs, PlainCosts)
    for name in ROLLUPS:
        read = getattr(page, name)().inputFiles()
        assert not [f for f in read if "/facts/" in f]
    options = filter_options(store.read_employees(spark, root), parts.read_parts(spark, root))
    t = store.stored_tables(spark, root)
    assert rows(options) == rows(filter_options(t.employees, t.api_requests))
    assert not [f for f in options.inputFiles() if "/facts/" in f]


def test_parts_follow_loads_replays_and_compaction(spark, scratch):
    src, root = logs(spark, scratch)
    store.load_telemetry(spark, root, src, load_id="a:b")
    same_page(spark, root, RANGES[1], ["kpi", "daily_usage"])
    # The same id with other rows replaces facts and parts; a second load adds to both.
    requests(spark, root, [0.25] * 6, "a:b")
    assert ("2024-01-03", "a%3Ab") not in store.part_pairs(spark, root)
    store.load_telemetry(spark, root, src)
    page = same_page(spark, root, RANGES[2], ["kpi", "daily_usage"])
    before = rows(page.daily_usage())
    assert store.compact(spark, root, "api_requests", "2024-01-04") == 2
    assert rows(same_page(spark, root, RANGES[2], ["kpi"]).daily_usage()) == before


def test_parts_of_any_costs_and_of_none(spark, scratch):
    _, root = logs(spark, scratch)
    empty = parts.stored_page(spark, root, UsageFilters(start="2024-01-01", end="2024-01-31"))
    assert empty.kpi().first().total_api_calls == 0 and empty.daily_usage().count() == 0
    requests(spark, root, [0.1, 0.2, 1234.5678, -3.25, None, 0.3], "plain")
    assert isinstance(same_page(spark, root, RANGES[2]).costs, PlainCosts)
    requests(spark, root, [1e300, 1e-300, 5e22, -1e300, 0.7, 2.0 ** 60, None], "odd")
    page = same_page(spark, root, RANGES[2], ["kpi", "daily_usage", "tokens_by_level"])
    assert isinstance(page.costs, BinnedCosts)
    requests(spark, root, [float("nan"), 1.0], "nan")
    same_page(spark, root, RANGES[2], ["daily_usage"])
