"""Dirty input, restarts and failures: what must not be lost, doubled or silently zeroed."""

import csv
import datetime as dt
import json
import math
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from usagelens.operators import decode as D
from usagelens.operators.costs import half_up_quotient
from usagelens.operators.rollups import UsagePage
from usagelens.schemas import FACT_SCHEMAS
from usagelens.sources import store
from usagelens.sources.employees import load_employee_csv, write_employee_csv
from usagelens.sources.standin import extreme_requests, standin_tables
from usagelens.streaming.incremental import run_incremental_load, stream_counts


def event(i, body="claude_code.user_prompt", day=1):
    message = {"body": body, "attributes": {"event.timestamp": f"2026-01-{day:02d}T10:00:00.000Z", "user.email": "a@x"}}
    return {"id": str(i), "message": json.dumps(message)}


def write_lines(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.writelines(x + "\n" for x in lines)


def envelope(*events):
    return json.dumps({"logEvents": list(events)})


def ids(spark, root):
    return sorted(r.event_id for r in store.read_facts(spark, root, "user_prompts").collect())


# -- numbers -----------------------------------------------------------------
def test_half_up_quotient_is_exact(spark):
    cases = [("0.000149999900000", 3, 4, 0.0), ("0.00015", 3, 4, 0.0001), ("1", 8, 2, 0.13), ("-1", 8, 2, -0.13),
             ("60000000000.000000000000001", 3, 5, 2e10), ("0", 5, 4, 0.0), ("99999999999999.999999999999999", 7, 2, 14285714285714.29)]
    rows = spark.createDataFrame([(t, n) for t, n, _, _ in cases], "t string, n bigint")
    for (t, n, scale, want) in cases:
        got = rows.where((F.col("t") == t) & (F.col("n") == n)).select(
            half_up_quotient(F.col("t").cast("decimal(38,15)"), F.col("n"), scale).alias("q")).first().q
        assert got == want, (t, n, scale)


def test_join_shapes_agree_on_costs_of_any_size(spark):
    t = standin_tables(spark, SF_SMALL)
    t = replace(t, api_requests=extreme_requests(t.api_requests))
    for method in ("kpi", "tokens_by_level", "cost_by_practice"):
        rows = [getattr(UsagePage(t, broadcast=b), method)().collect() for b in (True, False)]
        shared = UsagePage(t, broadcast=True).share()
        rows.append(getattr(shared, method)().collect())
        shared.unshare()
        assert rows[0] == rows[1] == rows[2]


@pytest.mark.parametrize("value, check", [(float("nan"), math.isnan), (float("inf"), math.isinf)])
def test_non_finite_costs_show(spark, value, check):
    t = standin_tables(spark, SF_SMALL)
    bad = F.when(F.col("event_id") == t.api_requests.agg(F.min("event_id")).first()[0], F.lit(value)).otherwise(F.col("cost_usd"))
    t = replace(t, api_requests=t.api_requests.withColumn("cost_usd", bad))
    row = UsagePage(t, broadcast=True).kpi().first()
    assert check(row.total_cost) and check(row.avg_cost_per_call)


# -- decode --------------------------------------------------------------------
def test_strict_json_and_odd_elements(spark):
    good = event(1)
    lines = ["{'logEvents': []}", envelope(5, good), envelope("text", good, None),
             envelope({"id": "2", "message": "{'body': 'claude_code.user_prompt'}"})]
    counts = {r.counter: r.n for r in D.load_counts(spark.createDataFrame([(x,) for x in lines], "value string")).collect()}
    assert counts["malformed_lines"] == 1
    assert counts["user_prompts"] == 2
    assert counts["skipped"] == 4  # 5, "text", null, the single-quoted message
    assert counts["total_events"] == 6


def test_json_true_is_one_and_its_text_is_not(spark):
    def request(i, value):
        message = {"body": "claude_code.api_request", "attributes": {"cost_usd": value, "input_tokens": value}}
        return envelope({"id": i, "message": json.dumps(message)})

    values = {"a": True, "b": "true", "c": False, "d": 1.5, "e": "1.5", "f": None, "g": 3_000_000_000}
    lines = spark.createDataFrame([(request(i, v),) for i, v in values.items()], "value string")
    got = {r.event_id: (r.cost_usd, r.input_tokens) for r in D.fact_table(D.decode_lines(lines), "api_requests").collect()}
    assert got == {"a": (1.0, 1), "b": (0.0, 0), "c": (0.0, 0), "d": (1.5, 1), "e": (1.5, 1), "f": (0.0, 0),
                   "g": (3e9, 3_000_000_000)}


# -- CSV -------------------------------------------------------------------------
HEADER = ["email", "full_name", "practice", "level", "location"]


def test_standard_csv_and_column_order(spark, scratch):
    a, b = f"{scratch}/in/a.csv", f"{scratch}/in/b.csv"
    os.makedirs(f"{scratch}/in")
    rows = [["a@x", 'Bob "Bo" B, Jr', "ML", "L1", "DE"], ["b@x", "two\nlines", "ML", "L1", "DE"], ["c@x", "back\\", "ML", "L1", "DE"]]
    with open(a, "w", newline="") as f:
        csv.writer(f).writerows([HEADER, *rows])
    with open(b, "w", newline="") as f:
        csv.writer(f).writerows([HEADER[::-1], ["FR", "L2", "QA", "Dora", "d@x"]])
    got = {r.email: list(r) for r in load_employee_csv(spark, f"{scratch}/in").select(*HEADER).collect()}
    assert got == {r[0]: r for r in [*rows, ["d@x", "Dora", "QA", "L2", "FR"]]}


def test_written_csv_reads_in_python(spark, scratch):
    rows = [("a@x", 'Bob "Bo", Jr', "M\nL", "L\\", "DE")]
    write_employee_csv(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in HEADER)), f"{scratch}/out")
    got = []
    for part in (x for x in os.listdir(f"{scratch}/out") if x.startswith("part-")):  # an empty part holds the header only
        with open(f"{scratch}/out/{part}", newline="") as f:
            header, *body = csv.reader(f)
            assert header == HEADER
            got += body
    assert got == [list(rows[0])]


# -- store --------------------------------------------------------------------------
def test_store_errors_are_raised(spark, scratch):
    assert store.read_employees(spark, scratch) is None
    assert store.read_facts(spark, scratch, "user_prompts").count() == 0
    for folder in ("facts/table=user_prompts/event_date=2026-01-01/load_id=x", "employees"):
        write_lines(f"{scratch}/{folder}/part-0.parquet", "garbage")
    with pytest.raises(Exception):
        store.read_facts(spark, scratch, "user_prompts").collect()
    with pytest.raises(Exception):
        store.append_employees(spark, scratch, f"{scratch}/none.csv")


def test_reading_a_table_lists_only_its_folder(spark, scratch):
    write_lines(f"{scratch}/logs/a", envelope(event(1)), envelope(event(2, day=2)))
    store.load_telemetry(spark, f"{scratch}/db", f"{scratch}/logs")
    files = store.read_facts(spark, f"{scratch}/db", "user_prompts").inputFiles()
    assert files and all("table=user_prompts" in f for f in files)
    plan = store.read_facts(spark, f"{scratch}/db", "user_prompts")._jdf.queryExecution().toString()
    assert "facts/table=user_prompts" in plan
    assert store.stored_days(spark, f"{scratch}/db", "user_prompts") == ["2026-01-01", "2026-01-02"]


def test_sql_declared_tables_and_compaction(spark, scratch):
    root = f"{scratch}/db"
    for k in range(3):
        write_lines(f"{scratch}/logs{k}/a", envelope(event(k)))
        store.load_telemetry(spark, root, f"{scratch}/logs{k}")
    sql = "SELECT event_id FROM {user_prompts} WHERE event_date = :day AND user_email = :who"
    ask = lambda: sorted(r[0] for r in store.query(spark, root, sql, {"day": dt.date(2026, 1, 1), "who": "a@x"}).collect())
    assert ask() == ["0", "1", "2"]
    prefix = f"t{os.path.basename(scratch).replace('-', '_').lower()}_"
    names = store.declare_tables(spark, root, prefix)
    assert store.declare_tables(spark, root, prefix) == names and len(names) == 1 + len(FACT_SCHEMAS)
    assert spark.table(f"{prefix}user_prompts").count() == 3
    assert store.compact(spark, root, "user_prompts", "2026-01-01") == 3
    assert store.compact(spark, root, "user_prompts", "2026-01-01") == 1
    assert ask() == ["0", "1", "2"]
    for n in names:
        spark.sql(f"DROP TABLE `{n}`")


# -- stream -----------------------------------------------------------------------------
def test_restart_rotation_and_two_sources(spark, scratch):
    root, src = f"{scratch}/db", f"{scratch}/in"
    write_lines(f"{src}/a", envelope(event(1), event(2)), "not json")
    first = run_incremental_load(spark, src, root)
    assert (first["user_prompts"], first["malformed_lines"]) == (2, 1)
    write_lines(f"{src}/b", envelope(event(3), event(4, body="other")))
    second = run_incremental_load(spark, src, root)
    assert (second["user_prompts"], second["skipped"]) == (1, 1)
    # Another application has no other memory than the store: nothing new, nothing twice.
    other = spark.newSession()
    assert run_incremental_load(other, src, root) == {}
    assert ids(spark, root) == ["1", "2", "3"]
    # The old files go, a new one of the same day comes.
    os.rename(f"{src}/a", f"{scratch}/a-gone")
    write_lines(f"{src}/c", envelope(event(5)))
    run_incremental_load(other, src, root)
    assert ids(spark, root) == ["1", "2", "3", "5"]
    # A second source: its own name, or a refusal.
    write_lines(f"{scratch}/in2/a", envelope(event(6)))
    with pytest.raises(ValueError, match="a name of its own"):
        run_incremental_load(spark, f"{scratch}/in2", root)
    run_incremental_load(spark, f"{scratch}/in2", root, name="second", spread_input=True)
    run_incremental_load(spark, f"{scratch}/in2", root, name="third", checkpoint=f"{scratch}/ck")
    assert ids(spark, root) == ["1", "2", "3", "5", "6", "6"]
    assert stream_counts(spark, root).where("counter = 'user_prompts'").agg(F.sum("n")).first()[0] == 4


def test_checkpoint_does_not_depend_on_the_application(spark, scratch):
    write_lines(f"{scratch}/in/a", envelope(event(1)))
    run_incremental_load(spark, f"{scratch}/in", f"{scratch}/db")
    assert os.path.isdir(f"{scratch}/db/_stream/telemetry/checkpoint/commits")


def test_empty_pick_admits_nothing(spark):
    from usagelens.operators.filters import UsageFilters

    row = UsagePage(standin_tables(spark, SF_SMALL), UsageFilters(models=())).kpi().first()
    assert (row.total_sessions, row.total_api_calls, row.total_cost, row.active_users) == (0, 0, None, 0)
