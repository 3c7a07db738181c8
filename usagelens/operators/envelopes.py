"""The log writer's side: fact rows -> telemetry events -> log-batch envelopes.

G1 order by event time, G2 pack consecutive events into envelopes of at most
``size`` events, G3 partition columns from the envelope's first event, G4 epoch
milliseconds, S7 one JSON envelope per line.

Packing never puts a whole day (or any unbounded group, even one of exact copies)
into one task: events are range-partitioned on ``(event_time, log_id, copy number)``
and sorted within each partition;
``monotonically_increasing_id`` then numbers rows in that order inside each
partition, and an envelope is a run of ``size`` consecutive rows of one partition
and one day. Envelopes therefore hold 1..size time-consecutive events of a single
day; where a run crosses a day or partition edge it is cut short (the writer's
own batches are of random size 1..10). The only other shuffle is the grouping of
<= ``size`` rows per envelope, which cannot skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.functions.casts import format_event_ts
from usagelens.operators.decode import BODY_KIND
from usagelens.tables import UsageTables

# Constant log metadata of every envelope.
MESSAGE_TYPE = "DATA_MESSAGE"
OWNER = "123456789012"
LOG_GROUP = "/claude-code/telemetry"
LOG_STREAM = "otel-collector"
SUBSCRIPTION_FILTERS = ["logs-to-s3"]
DEFAULT_SIZE = 10
BODY = {kind: body for body, kind in BODY_KIND.items()}

_LOW_BITS = (1 << 33) - 1  # monotonically_increasing_id: partition << 33 | row number


def epoch_millis(ts: Column | str) -> Column:
    """Zone-less event time -> epoch milliseconds (no session-zone dependence)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)


def _attr_map(pairs: dict[str, Column], drop_nulls: bool = False) -> Column:
    m = F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), v.cast("string"))])
    return F.map_filter(m, lambda k, v: v.isNotNull()) if drop_nulls else m


def _common() -> dict[str, Column]:
    return {
        "event.timestamp": format_event_ts("timestamp"),
        "session.id": F.col("session_id"),
        "user.email": F.col("user_email"),
    }


def encode_facts(tables: UsageTables) -> DataFrame:
    """Fact rows as telemetry events: ``(event_time, log_id, body, message)``, where
    ``message`` is the event as a struct (``body``, ``attributes``, ``scope``,
    ``resource``); ``pack_envelopes`` renders it as JSON text after its range
    shuffle, so the sampling pass of that shuffle stays cheap. Numbers travel as
    text, as the writer sends them; decoding the result gives the facts back at
    millisecond precision."""
    empty = F.create_map().cast("map<string,string>")

    def event(df: DataFrame, body: Column, attrs: dict[str, Column], extra_nullable: dict[str, Column],
              resource: Column, scope: Column) -> DataFrame:
        a = F.map_concat(_attr_map({**_common(), **attrs}), _attr_map(extra_nullable, drop_nulls=True))
        msg = F.struct(body.alias("body"), a.alias("attributes"), scope.alias("scope"), resource.alias("resource"))
        return df.select(F.col("timestamp").alias("event_time"), F.col("event_id").alias("log_id"),
                         body.alias("body"), msg.alias("message"))

    r = tables.api_requests
    requests = event(
        r, F.lit(BODY["api_request"]),
        {"terminal.type": F.col("terminal_type"), "model": F.col("model"), "cost_usd": F.col("cost_usd"),
         "input_tokens": F.col("input_tokens"), "output_tokens": F.col("output_tokens"),
         "cache_read_tokens": F.col("cache_read_tokens"),
         "cache_creation_tokens": F.col("cache_creation_tokens"), "duration_ms": F.col("duration_ms")},
        {}, _attr_map({"os.type": F.col("os_type")}), _attr_map({"version": F.col("client_version")}),
    )
    prompts = event(tables.user_prompts, F.lit(BODY["user_prompt"]),
                    {"prompt_length": F.col("prompt_length")}, {}, empty, empty)
    t = tables.tool_events
    tools = event(
        t,
        F.when(F.col("event_type") == "decision", F.lit(BODY["tool_decision"]))
        .otherwise(F.lit(BODY["tool_result"])),
        {"tool_name": F.col("tool_name")},
        {"decision": F.col("decision"), "success": F.lower(F.col("success").cast("string")),
         "duration_ms": F.col("duration_ms")},
        empty, empty,
    )
    errors = event(
        tables.api_errors, F.lit(BODY["api_error"]),
        {"model": F.col("model"), "error": F.col("error_message"), "status_code": F.col("status_code"),
         "attempt": F.col("attempt"), "duration_ms": F.col("duration_ms")},
        {}, empty, empty,
    )
    return requests.unionByName(prompts).unionByName(tools).unionByName(errors)


def range_ordered(events: DataFrame, partitions: int | None = None) -> DataFrame:
    """G1: events range-partitioned on time and sorted inside each partition, with
    ``_pos`` numbering them in that order (``partition << 33 | row``).

    The last range key ``_copy`` is a per-row number taken before the shuffle, so
    the range bounds can cut even a group of exact copies of one event (the same
    event sent many times) across tasks, however large it is. Copies are equal in
    every column, so how they are cut cannot change any envelope's content, and the
    number depends only on the input splits, so a recomputed task sees the same."""
    tagged = events.withColumn("_copy", F.monotonically_increasing_id())
    keys = ("event_time", "log_id", "_copy")
    # Without an explicit count the range exchange uses the session's partition
    # number and AQE may merge neighbouring ranges (still contiguous in time).
    by_range = tagged.repartitionByRange(partitions, *keys) if partitions else tagged.repartitionByRange(*keys)
    if not isinstance(events.schema["message"].dataType, T.StringType):
        by_range = by_range.withColumn("message", F.to_json("message"))
    # A total order up to exact copies (the message text breaks ties between
    # repeated ids), so row numbers are the same if a lost task is recomputed.
    return (
        by_range.sortWithinPartitions("event_time", "log_id", "message")
        .withColumn("_pos", F.monotonically_increasing_id())
    )


def pack_envelopes(events: DataFrame, size: int = DEFAULT_SIZE, partitions: int | None = None) -> DataFrame:
    """Envelopes of at most ``size`` consecutive events of one day.

    ``events`` has ``event_time``, ``log_id``, ``message`` (JSON text, or a struct
    rendered here). Result columns: ``year``, ``month``, ``day`` (of the first
    event), ``logEvents`` (array of ``{id, timestamp, message}`` in time order)."""
    ordered = range_ordered(events, partitions)
    keyed = ordered.select(
        F.shiftright("_pos", 33).alias("_part"),
        F.floor(F.col("_pos").bitwiseAND(F.lit(_LOW_BITS)) / size).alias("_run"),
        F.to_date("event_time").alias("_day"),
        F.struct(
            F.col("event_time").alias("t"), F.col("log_id").alias("id"),
            epoch_millis("event_time").alias("timestamp"), F.col("message").alias("message"),
        ).alias("e"),
    )
    grouped = keyed.groupBy("_part", "_run", "_day").agg(F.array_sort(F.collect_list("e")).alias("es"))
    return grouped.select(
        F.year("_day").alias("year"), F.month("_day").alias("month"), F.dayofmonth("_day").alias("day"),
        F.transform("es", lambda e: F.struct(e["id"].alias("id"), e["timestamp"].alias("timestamp"),
                                             e["message"].alias("message"))).alias("logEvents"),
    )


def envelope_lines(envelopes: DataFrame) -> DataFrame:
    """One JSON text per envelope (column ``value``), plus the partition columns."""
    env = F.struct(
        F.lit(MESSAGE_TYPE).alias("messageType"), F.lit(OWNER).alias("owner"),
        F.lit(LOG_GROUP).alias("logGroup"), F.lit(LOG_STREAM).alias("logStream"),
        F.array(*[F.lit(s) for s in SUBSCRIPTION_FILTERS]).alias("subscriptionFilters"),
        F.col("logEvents"), F.col("year"), F.col("month"), F.col("day"),
    )
    return envelopes.select(F.to_json(env).alias("value"), "year", "month", "day")


def write_envelopes(envelopes: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """S7 sink: JSON lines, one folder per year/month/day.

    The envelopes leave their grouping shuffle spread by envelope, so every task
    holds some of every day; a REBALANCE on the day brings each day's lines to few
    tasks (AQE splits a busy day by size), giving few files per day folder."""
    lines = envelope_lines(envelopes).hint("rebalance", "year", "month", "day")
    lines.write.mode(mode).partitionBy("year", "month", "day").text(path)


def envelope_days(envelopes: DataFrame) -> DataFrame:
    """Per day: envelopes' event count, first and last epoch ms, largest envelope."""
    return envelopes.groupBy("year", "month", "day").agg(
        F.sum(F.size("logEvents")).alias("events"),
        F.min(F.col("logEvents")[0]["timestamp"]).alias("first_ms"),
        F.max(F.element_at("logEvents", -1)["timestamp"]).alias("last_ms"),
    )
