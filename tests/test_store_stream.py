"""S4-S6 stored tables (batch load, pruning) and S9 incremental stream load."""

import os
import shutil

from pyspark.sql import functions as F

from conftest import SF_SMALL
from usagelens.operators.envelopes import encode_facts, pack_envelopes, write_envelopes
from usagelens.operators.filters import UsageFilters
from usagelens.operators.rollups import UsagePage
from usagelens.sources import store
from usagelens.sources.employees import write_employee_csv
from usagelens.sources.standin import standin_tables
from usagelens.streaming.incremental import run_incremental_load, stream_counts

RANGE = UsageFilters(start="2024-01-03", end="2024-01-20", end_day="whole")


def logs_and_csv(spark, scratch):
    t = standin_tables(spark, SF_SMALL)
    write_envelopes(pack_envelopes(encode_facts(t)), f"{scratch}/logs")
    write_employee_csv(t.employees, f"{scratch}/emp")
    return t


def test_batch_load_equals_source(spark, scratch):
    t = logs_and_csv(spark, scratch)
    root = f"{scratch}/db"
    assert store.append_employees(spark, root, f"{scratch}/emp") == t.employees.count()
    rep = store.load_telemetry(spark, root, f"{scratch}/logs")
    c = rep.counts
    assert c["malformed_lines"] == 0 and c["skipped"] == 0
    assert c["api_requests"] + c["user_prompts"] + c["tool_events"] + c["api_errors"] == c["total_events"] == 1000
    stored = store.stored_tables(spark, root)
    for m in ("kpi", "daily_usage", "top_engineers", "tool_success", "top_errors"):
        a = getattr(UsagePage(stored, RANGE), m)().collect()
        b = getattr(UsagePage(t, RANGE), m)().collect()
        assert sorted(map(tuple, a)) == sorted(map(tuple, b)), m
    # a second load of the same files doubles the rows, as the reference does
    store.load_telemetry(spark, root, f"{scratch}/logs")
    assert store.read_facts(spark, root, "api_requests").count() == 2 * c["api_requests"]


def test_day_pruning_reaches_the_scan(spark, scratch):
    logs_and_csv(spark, scratch)
    root = f"{scratch}/db"
    store.append_employees(spark, root, f"{scratch}/emp")
    store.load_telemetry(spark, root, f"{scratch}/logs")
    df = UsagePage(store.stored_tables(spark, root), RANGE).kpi()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(table" in plan or "PartitionFilters: [" in plan
    assert "event_date" in plan.split("PartitionFilters")[1].split("]")[0]


def test_stream_equals_batch_and_is_incremental(spark, scratch):
    logs_and_csv(spark, scratch)
    files = sorted(os.path.join(d, f) for d, _, fs in os.walk(f"{scratch}/logs") for f in fs if f.startswith("part-"))
    src = f"{scratch}/incoming"
    os.makedirs(src)
    first, rest = files[: len(files) // 2], files[len(files) // 2:]
    for i, f in enumerate(first):
        shutil.copy(f, f"{src}/f{i}.json")
    root = f"{scratch}/sdb"
    ckpt = f"{scratch}/ckpt"
    run_incremental_load(spark, src, root, checkpoint=ckpt, max_files_per_trigger=2)
    n1 = store.read_facts(spark, root, "api_requests").count()
    run_incremental_load(spark, src, root, checkpoint=ckpt)          # nothing new: nothing added
    assert store.read_facts(spark, root, "api_requests").count() == n1
    for i, f in enumerate(rest):
        shutil.copy(f, f"{src}/g{i}.json")
    run_incremental_load(spark, src, root, checkpoint=ckpt)
    broot = f"{scratch}/bdb"
    store.load_telemetry(spark, broot, f"{scratch}/logs")
    for t in ("api_requests", "user_prompts", "tool_events", "api_errors"):
        s = store.read_facts(spark, root, t).drop("load_id", "event_date")
        b = store.read_facts(spark, broot, t).drop("load_id", "event_date")
        assert s.exceptAll(b).count() == 0 and b.exceptAll(s).count() == 0, t


def test_replayed_batch_overwrites_its_own_output(spark, scratch):
    logs_and_csv(spark, scratch)
    from usagelens.operators import decode as D
    from usagelens.sources.telemetry import read_log_lines

    decoded = D.decode_lines(read_log_lines(spark, f"{scratch}/logs"))
    root = f"{scratch}/rdb"
    store.write_facts(decoded, root, "s-7")
    store.write_facts(decoded, root, "s-7")       # replay of batch 7
    store.write_facts(decoded, root, "s-8", files_per_day=2)
    n = decoded.where(F.col("kind") == "api_request").count()
    assert store.read_facts(spark, root, "api_requests").count() == 2 * n


def test_malformed_lines_are_quarantined_in_the_same_load(spark, scratch):
    import json

    good = json.dumps({"logEvents": [{"id": "1", "message": json.dumps(
        {"body": "claude_code.api_request", "attributes": {"event.timestamp": "2026-01-31T12:00:00.123Z"}})},
        {"id": "2", "message": "bad"}]})
    os.makedirs(f"{scratch}/q")
    with open(f"{scratch}/q/x.jsonl", "w") as f:
        f.write("\n".join([good, "not json", "", '{"logEvents": []}', '{"a":1} junk']) + "\n")
    rep = store.load_telemetry(spark, f"{scratch}/qdb", f"{scratch}/q", max_records_per_file=1000)
    c = rep.counts
    assert (c["api_requests"], c["skipped"], c["total_events"], c["malformed_lines"]) == (1, 1, 2, 2)
    q = sorted(r.line for r in store.read_quarantine(spark, f"{scratch}/qdb").collect())
    assert q == ['not json', '{"a":1} junk']
    assert store.read_facts(spark, f"{scratch}/qdb", "api_requests").count() == 1


def _files_per_folder(root):
    counts = {}
    for d, _, fs in os.walk(root):
        n = sum(1 for f in fs if f.endswith(".parquet"))
        if n:
            counts[d] = n
    return counts


def test_rebalanced_write_gives_one_file_per_table_day(spark, scratch):
    """Read tasks mix days (Spark packs small input files together); the default
    layout still writes one file per (table, day) at this size, and the narrow
    layout stores the same rows."""
    logs_and_csv(spark, scratch)
    store.load_telemetry(spark, f"{scratch}/rb", f"{scratch}/logs")
    store.load_telemetry(spark, f"{scratch}/nw", f"{scratch}/logs", layout="narrow")
    per_folder = _files_per_folder(f"{scratch}/rb")
    assert per_folder and set(per_folder.values()) == {1}
    assert sum(_files_per_folder(f"{scratch}/nw").values()) >= len(per_folder)
    for t in ("api_requests", "tool_events"):
        a = store.read_facts(spark, f"{scratch}/rb", t).drop("load_id")
        b = store.read_facts(spark, f"{scratch}/nw", t).drop("load_id")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, t


def test_one_gzip_file_is_spread_before_decoding(spark, scratch):
    """All lines in one unsplittable gzip file: read in one task, then rebalanced
    over several tasks for the decode; the load gives the same counts."""
    import gzip

    from usagelens.sources.telemetry import read_log_lines

    logs_and_csv(spark, scratch)
    text = [ln for d, _, fs in os.walk(f"{scratch}/logs") for f in sorted(fs) if f.startswith("part-")
            for ln in open(os.path.join(d, f), encoding="utf-8")]
    os.makedirs(f"{scratch}/gz")
    with gzip.open(f"{scratch}/gz/all.json.gz", "wt", encoding="utf-8") as out:
        out.writelines(text)
    # Small target sizes so this small file is cut (AQE keeps partitions of at
    # least minPartitionSize, 1 MB by default).
    keys = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize"]
    old = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "16k")
    try:
        raw = read_log_lines(spark, f"{scratch}/gz", spread_input=False)
        spread = read_log_lines(spark, f"{scratch}/gz", spread_input="always")
        def tasks(df):   # the line is carried, as in the decode (else the shuffle moves no bytes)
            return len(df.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(F.length("value"))).collect())

        assert tasks(raw) == 1 and tasks(spread) > 1
        a = store.load_telemetry(spark, f"{scratch}/ga", f"{scratch}/gz", spread_input="always").counts
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    b = store.load_telemetry(spark, f"{scratch}/gb", f"{scratch}/logs").counts
    assert a == b and a["total_events"] == 1000


def test_stream_counts_every_batch_of_a_run(spark, scratch):
    """More batches than Spark keeps progress of."""
    logs_and_csv(spark, scratch)
    files = sorted(os.path.join(d, f) for d, _, fs in os.walk(f"{scratch}/logs") for f in fs if f.startswith("part-"))[:5]
    os.makedirs(f"{scratch}/in")
    for i, f in enumerate(files):
        shutil.copy(f, f"{scratch}/in/f{i}.json")
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(kept, 2)
    try:
        got = run_incremental_load(spark, f"{scratch}/in", f"{scratch}/db", max_files_per_trigger=1)
    finally:
        spark.conf.unset(kept)
    stored = {r["counter"]: r["n"] for r in stream_counts(spark, f"{scratch}/db").groupBy("counter").agg(F.sum("n").alias("n")).collect()}
    assert len(files) == 5 and got == stored and sum(got.values()) > 0
