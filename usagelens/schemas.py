"""Fixed table schemas: the employee dimension, the four fact tables, the raw log shapes."""

from __future__ import annotations

from pyspark.sql import types as T

# Counts are BIGINT: a token count can pass 32 bits.
S, I, TS, D, B = T.StringType(), T.LongType(), T.TimestampNTZType(), T.DoubleType(), T.BooleanType()


def _struct(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


EMPLOYEES = _struct(("email", S), ("full_name", S), ("practice", S), ("level", S), ("location", S))

API_REQUESTS = _struct(
    ("event_id", S), ("session_id", S), ("user_email", S), ("timestamp", TS), ("model", S),
    ("cost_usd", D), ("input_tokens", I), ("output_tokens", I), ("cache_read_tokens", I),
    ("cache_creation_tokens", I), ("duration_ms", I), ("os_type", S), ("terminal_type", S),
    ("client_version", S),
)

USER_PROMPTS = _struct(
    ("event_id", S), ("session_id", S), ("user_email", S), ("timestamp", TS), ("prompt_length", I),
)

TOOL_EVENTS = _struct(
    ("event_id", S), ("session_id", S), ("user_email", S), ("timestamp", TS), ("event_type", S),
    ("tool_name", S), ("decision", S), ("success", B), ("duration_ms", I),
)

API_ERRORS = _struct(
    ("event_id", S), ("session_id", S), ("user_email", S), ("timestamp", TS), ("model", S),
    ("error_message", S), ("status_code", S), ("attempt", I), ("duration_ms", I),
)

FACT_SCHEMAS = {
    "api_requests": API_REQUESTS,
    "user_prompts": USER_PROMPTS,
    "tool_events": TOOL_EVENTS,
    "api_errors": API_ERRORS,
}

# Routing kind of each decoded event -> fact table it lands in.
KIND_TABLE = {
    "api_request": "api_requests",
    "user_prompt": "user_prompts",
    "tool_decision": "tool_events",
    "tool_result": "tool_events",
    "api_error": "api_errors",
}

# One wide row that holds every fact column; each table is a projection of it.
DECODED_COLUMNS: list[tuple[str, T.DataType]] = []
for _schema in FACT_SCHEMAS.values():
    for _f in _schema.fields:
        if _f.name not in [c for c, _ in DECODED_COLUMNS]:
            DECODED_COLUMNS.append((_f.name, _f.dataType))
DECODED = _struct(*DECODED_COLUMNS)

# Raw JSON shapes. An envelope's log events are read as their JSON text, so that one odd
# element doesn't spoil its neighbours; each is then read as a string map, so that an
# absent key and a JSON null stay apart (ids) and object messages arrive as JSON text.
ENVELOPE_DDL = "array<struct<logEvents: array<string>>>"
LOG_EVENT_DDL = "array<map<string,string>>"
MESSAGE_DDL = (
    "array<struct<body: string, attributes: map<string,string>, "
    "resource: map<string,string>, scope: map<string,string>>>"
)
# Single quotes are not JSON (Spark's reader takes them by default).
STRICT_JSON = {"allowSingleQuotes": "false"}
