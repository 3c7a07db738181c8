"""G1-G4, S7 and the round trip events -> envelopes -> text -> decode."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from usagelens.operators import decode as D
from usagelens.operators.envelopes import encode_facts, envelope_lines, pack_envelopes, write_envelopes
from usagelens.sources.standin import standin_tables
from usagelens.sources.telemetry import read_log_lines


def test_envelopes_are_short_same_day_and_time_ordered(spark):
    env = pack_envelopes(encode_facts(standin_tables(spark, SF_SMALL)), size=10, partitions=3)
    rows = env.collect()
    assert sum(len(r.logEvents) for r in rows) == 1000
    for r in rows:
        assert 1 <= len(r.logEvents) <= 10
        ms = [e.timestamp for e in r.logEvents]
        assert ms == sorted(ms)
        days = {dt.datetime.fromtimestamp(m / 1000, dt.timezone.utc).date() for m in ms}
        assert days == {dt.date(r.year, r.month, r.day)}
    # consecutive: envelopes of one partition never interleave in time
    spans = sorted((r.logEvents[0].timestamp, r.logEvents[-1].timestamp) for r in rows)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_round_trip_through_files(spark, scratch):
    t = standin_tables(spark, SF_SMALL)
    write_envelopes(pack_envelopes(encode_facts(t)), f"{scratch}/logs")
    decoded = D.decode_lines(read_log_lines(spark, f"{scratch}/logs"))
    for name in ("api_requests", "user_prompts", "tool_events", "api_errors"):
        want = t.fact(name).withColumn("timestamp", F.date_trunc("millisecond", "timestamp").cast("timestamp_ntz"))
        got = D.fact_table(decoded, name)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, name


def test_envelope_json_shape(spark):
    import json

    env = pack_envelopes(encode_facts(standin_tables(spark, SF_SMALL)))
    line = json.loads(envelope_lines(env).first().value)
    assert set(line) == {"messageType", "owner", "logGroup", "logStream", "subscriptionFilters",
                         "logEvents", "year", "month", "day"}
    ev = line["logEvents"][0]
    assert isinstance(ev["id"], str) and isinstance(ev["timestamp"], int)
    inner = json.loads(ev["message"])
    assert inner["attributes"]["event.timestamp"].endswith("Z")
