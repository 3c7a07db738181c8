"""Decode log-batch JSON lines into routed, typed telemetry rows (all JVM-side).

line --strip, drop blank--> envelope (strict: exactly one JSON object per line,
with a list of log events, else the line is *malformed*: quarantined, not counted as skipped)
--explode logEvents--> log event --parse message (strict)--> telemetry event
--route on body--> kind in {api_request, user_prompt, tool_decision, tool_result,
api_error} or ``skipped`` (bad/missing message, unknown body).

The decoded frame is one wide row per log event holding every fact column; each
fact table is a projection of its kinds (``fact_table``). No shuffle anywhere:
decoding is a narrow map over the input splits.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.functions.casts import lookup, parse_event_ts, safe_bool, safe_float, safe_int, strip_ws
from usagelens.schemas import (DECODED, ENVELOPE_DDL, FACT_SCHEMAS, KIND_TABLE, LOG_EVENT_DDL, MESSAGE_DDL,
                               STRICT_JSON)

# The event bodies the loader routes on, and their kinds.
BODY_KIND = {
    "claude_code.api_request": "api_request",
    "claude_code.user_prompt": "user_prompt",
    "claude_code.tool_decision": "tool_decision",
    "claude_code.tool_result": "tool_result",
    "claude_code.api_error": "api_error",
}
SKIPPED = "skipped"
TABLE_KINDS = {t: [k for k, v in KIND_TABLE.items() if v == t] for t in FACT_SCHEMAS}


def ensure_semantics(spark) -> None:
    """A repeated key inside a JSON object keeps its last value (as Python's json
    does) instead of failing the job."""
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")


def last_wins(m: Column) -> Column:
    """A parsed JSON object as a map where a repeated key holds its last value
    (``from_json`` keeps every copy; rebuilding the map applies LAST_WIN)."""
    return F.map_from_entries(F.map_entries(m))


# The name of a field that no input can hold: made anew in every process.
_MARK = f"m{uuid.uuid4().hex}"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once (an expression used twice inside an
    array function would be computed twice)."""
    return F.transform(F.array(value), body).getItem(0)


def _marked(text: Column, ddl: str) -> Column:
    """``text`` as the first element of a JSON array whose last element is the mark. The
    reader stops at the first closing bracket, so text that closes the array itself
    (trailing junk after ``]``) loses the mark; a second value shows as a third element."""
    if ddl.endswith(">>") and "struct<" in ddl.split(":")[0]:
        ddl = f"{ddl[:-2]}, {_MARK}: string>>"
    return F.from_json(F.concat(F.lit("["), text, F.lit(f',{{"{_MARK}":"1"}}]')), ddl, STRICT_JSON)


def _is_sole(arr: Column) -> Column:
    """Whether a ``_marked`` array holds one value and the mark."""
    mark = arr.getItem(1).getItem(_MARK)
    return F.coalesce((F.size(arr) == 2) & arr.getItem(0).isNotNull() & mark.isNotNull(), F.lit(False))


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Stripped, non-blank lines with ``envelope_ok`` and the parsed envelope. A line that is
    not exactly one JSON object, or whose ``logEvents`` is neither a list nor null, is malformed."""
    spark = lines.sparkSession
    ensure_semantics(spark)
    text = strip_ws(F.col(column))
    stripped = lines.select(text.alias("line")).where(F.length("line") > 0)
    parsed = stripped.withColumn("_arr", _marked(F.col("line"), ENVELOPE_DDL))
    arr = F.col("_arr")
    # A list that did not come out is absent, null, or something else: only then its text is read.
    other = _marked(F.col("line"), "array<struct<logEvents: string>>").getItem(0).getField("logEvents")
    listed = F.when(arr.getItem(0).getField("logEvents").isNull(), other.isNull()).otherwise(F.lit(True))
    return parsed.select("line", (_is_sole(arr) & listed).alias("envelope_ok"), arr.getItem(0).alias("envelope"))


def parsed_events(log_events: Column) -> Column:
    """An envelope's log events (JSON texts), each as ``struct(log_event, _msg)``: the
    event map with repeated keys resolved, and its message parsed (marked, for the
    strict one-object test). Elements are parsed one by one: one that isn't an object
    has a NULL map and message, and is a skipped event like any other bad one.

    Parsing inside the array, before the explode, is what keeps the message parse
    to one per event: a later filter on the routing kind (a fact table's rows, the
    skipped events left out of the store) cannot be pushed below the explode, so it
    reads the parsed value instead of Catalyst inlining a fresh parse into it."""
    def element(text: Column) -> Column:
        return _let(_marked(text, LOG_EVENT_DDL), lambda arr: F.when(_is_sole(arr), last_wins(arr.getItem(0))))

    def one(le: Column) -> Column:
        return F.struct(le.alias("log_event"), _marked(F.element_at(le, F.lit("message")), MESSAGE_DDL).alias("_msg"))

    return F.transform(F.transform(log_events, element), one)


def log_events(parsed: DataFrame) -> DataFrame:
    """One row per log event of every good envelope (``log_event``, with the
    parsed message in ``_msg``); a missing or NULL list gives no rows.

    No ``where(envelope_ok)`` first: Catalyst would push that filter below the
    parse and inline it, parsing each line again for the test; exploding NULL for
    a bad envelope drops it with the one parse."""
    events = parsed_events(F.when(F.col("envelope_ok"), F.col("envelope.logEvents")))
    return parsed.select(F.explode(events).alias("_ev")).select(
        F.col("_ev.log_event").alias("log_event"), F.col("_ev._msg").alias("_msg"))


def telemetry(events: DataFrame) -> DataFrame:
    """D3: parse each log event's message; adds ``message_ok`` and ``event``.

    Uses the message parsed before the explode (``_msg``, see ``parsed_events``)
    when the rows carry it; otherwise parses here, in its own projection, so the
    parsed value is computed once per row and then read by the many field
    expressions (Catalyst does not merge a projection whose costly results are
    used more than once)."""
    if "_msg" in events.columns:
        staged = events
    else:
        msg = F.element_at(F.col("log_event"), F.lit("message"))
        staged = events.withColumn("log_event", last_wins(F.col("log_event"))).withColumn("_msg", _marked(msg, MESSAGE_DDL))
    return staged.select(
        *[c for c in events.columns if c != "_msg"], _is_sole(F.col("_msg")).alias("message_ok"),
        F.col("_msg").getItem(0).alias("event"),
    )


def _kind(ok: Column, body: Column) -> Column:
    routed = F.element_at(F.create_map(*[F.lit(x) for kv in BODY_KIND.items() for x in kv]), body)
    return F.when(ok, F.coalesce(routed, F.lit(SKIPPED))).otherwise(F.lit(SKIPPED))


def decode(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Route each log event and cast its fields; one wide row per event.

    Columns: ``kind``, ``body``, every fact column (NULL where the kind has none),
    and the ``keep`` columns of the input."""
    empty = F.create_map().cast("map<string,string>")
    t = telemetry(events).select(
        *keep,
        F.col("log_event").alias("le"),
        _kind(F.col("message_ok"), F.col("event.body")).alias("kind"),
        F.col("event.body").alias("body"),
        last_wins(F.coalesce(F.col("event.attributes"), empty)).alias("attrs"),
        last_wins(F.coalesce(F.col("event.resource"), empty)).alias("resource"),
        last_wins(F.coalesce(F.col("event.scope"), empty)).alias("scope"),
    )
    attrs, resource, scope, le, kind = (F.col(c) for c in ("attrs", "resource", "scope", "le", "kind"))
    a = lambda key: F.element_at(attrs, F.lit(key))  # noqa: E731  (NULL when absent)

    def only(kinds: list[str], value: Column) -> Column:
        return F.when(kind.isin(kinds), value)

    def number(key: str, cast) -> Column:
        """A numeric attribute. The map holds JSON true and the text "true" alike; only the
        first is 1 to Python, so a value that reads so is looked up in the message."""
        message = F.try_parse_json(F.element_at(le, F.lit("message")))
        kind_of = F.schema_of_variant(F.try_variant_get(message, f'$.attributes["{key}"]', "variant"))
        value = cast(a(key))
        return F.when((a(key) == "true") & (kind_of == "BOOLEAN"), F.lit(1)).otherwise(value)

    req, err, dec, res = ["api_request"], ["api_error"], ["tool_decision"], ["tool_result"]
    values: dict[str, Column] = {
        "event_id": F.when(F.map_contains_key(le, F.lit("id")),
                           F.coalesce(F.element_at(le, F.lit("id")), F.lit("None"))).otherwise(F.lit("")),
        "session_id": lookup(attrs, "session.id"),
        "user_email": lookup(attrs, "user.email"),
        "timestamp": parse_event_ts(lookup(attrs, "event.timestamp")),
        "model": only(req + err, lookup(attrs, "model")),
        "cost_usd": only(req, number("cost_usd", safe_float)),
        "input_tokens": only(req, number("input_tokens", safe_int)),
        "output_tokens": only(req, number("output_tokens", safe_int)),
        "cache_read_tokens": only(req, number("cache_read_tokens", safe_int)),
        "cache_creation_tokens": only(req, number("cache_creation_tokens", safe_int)),
        "duration_ms": only(req + res + err, number("duration_ms", safe_int)),
        "os_type": only(req, lookup(resource, "os.type")),
        "terminal_type": only(req, lookup(attrs, "terminal.type")),
        "client_version": only(req, lookup(scope, "version")),
        "prompt_length": only(["user_prompt"], number("prompt_length", safe_int)),
        "event_type": F.when(kind == "tool_decision", F.lit("decision")).when(kind == "tool_result", F.lit("result")),
        "tool_name": only(dec + res, lookup(attrs, "tool_name")),
        "decision": only(dec, lookup(attrs, "decision")),
        "success": only(res, safe_bool(a("success"))),
        "error_message": only(err, lookup(attrs, "error")),
        "status_code": only(err, lookup(attrs, "status_code")),
        "attempt": only(err, number("attempt", safe_int)),
    }
    cols = [values[f.name].cast(f.dataType).alias(f.name) for f in DECODED.fields]
    return t.select(*keep, "kind", "body", *cols)


def fact_table(decoded: DataFrame, table: str) -> DataFrame:
    """The rows and columns of one fact table."""
    schema = FACT_SCHEMAS[table]
    return decoded.where(F.col("kind").isin(TABLE_KINDS[table])).select(*[f.name for f in schema.fields])


def decode_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines of text -> decoded wide rows (malformed lines dropped)."""
    return decode(log_events(parse_lines(lines, column)))


def decode_with_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Decoded events plus one placeholder row per malformed line or envelope
    without events (``posexplode_outer``), keeping ``line`` (malformed ones), ``envelope_ok`` and
    ``pos`` (NULL on placeholders), so line- and event-level work share one pass."""
    parsed = parse_lines(lines, column)
    # Only a malformed line is kept beyond here: a good one would ride on all its events.
    rows = parsed.select(
        F.when(~F.col("envelope_ok"), F.col("line")).alias("line"), "envelope_ok",
        F.posexplode_outer(parsed_events(F.when(F.col("envelope_ok"), F.col("envelope.logEvents"))))
        .alias("pos", "_ev"),
    ).select("line", "envelope_ok", "pos", F.col("_ev.log_event").alias("log_event"),
             F.col("_ev._msg").alias("_msg"))
    return decode(rows, keep=("line", "envelope_ok", "pos"))


def count_columns() -> dict[str, Column]:
    """D17 counters over ``decode_with_lines`` rows."""
    is_event = F.col("pos").isNotNull()
    counters = {t: F.count_if(is_event & F.col("kind").isin(k)) for t, k in TABLE_KINDS.items()}
    counters["skipped"] = F.count_if(is_event & (F.col("kind") == SKIPPED))
    counters["total_events"] = F.count_if(is_event)
    counters["malformed_lines"] = F.count_if(~F.col("envelope_ok"))
    return counters


def load_counts(lines: DataFrame, column: str = "value") -> DataFrame:
    """Rows per fact table, skipped events, all events and malformed lines, in
    one pass over the input, as ``(counter, n)`` rows. Invariant: the four table
    counts plus ``skipped`` equal ``total_events``."""
    counters = count_columns()
    wide = decode_with_lines(lines, column).agg(*[c.alias(n) for n, c in counters.items()])
    return wide.unpivot([], list(counters), "counter", "n")


def route_counts(decoded: DataFrame) -> DataFrame:
    """Events per routing kind (five kinds and ``skipped``)."""
    return decoded.groupBy("kind").agg(F.count(F.lit(1)).alias("events"))
