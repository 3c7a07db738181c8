"""DuckDB SQL for each registered query, over the driver's pre-registered tables.

The stand-in views of ``sources/standin.py`` are restated here as CTEs, then each
query is asked over one view per fact that holds the filtered join (``hits``), with the
numeric rules of ``operators/rollups.py`` made explicit (decimal cost sums, half-up
quotients in integers, BIGINT counts, weekday numbers 1 = Sunday, tie-breaks at LIMITs).
"""

from __future__ import annotations

from usagelens.functions.labels import MODEL_DATE_SUFFIX, MODEL_PREFIX, WEEKDAY_NAMES
from usagelens.operators.decode import BODY_KIND
from usagelens.operators.filters import UsageFilters
from usagelens.sources.standin import DIRTY_NUMBERS, ERROR_TEXT_HEAD, ERROR_TEXT_TAIL, MODEL_HEAD, MODEL_TAIL

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def _common() -> str:
    return (
        "CAST(event_id AS VARCHAR) AS event_id, "
        "CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id, "
        "CAST(user_id AS VARCHAR) AS user_email, ts AS \"timestamp\""
    )


MODEL = f"'{MODEL_HEAD}' || CAST(k % 5 AS VARCHAR) || '{MODEL_TAIL}' || CAST(k % 5 AS VARCHAR)"

VIEWS = f"""
ev AS (SELECT *, {K} AS k FROM events),
employees AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS email, c.c_name AS full_name, c.c_mktsegment AS practice,
         'L' || CAST(1 + c.c_custkey % 10 AS VARCHAR) AS level, r.r_name AS location
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                  JOIN region r ON n.n_regionkey = r.r_regionkey),
api_requests AS (
  SELECT {_common()}, {MODEL} AS model, CAST(value AS DOUBLE) AS cost_usd,
         CAST(k * 10 AS BIGINT) AS input_tokens, CAST(k + 1 AS BIGINT) AS output_tokens,
         CAST(k * 100 AS BIGINT) AS cache_read_tokens, CAST(k * 20 AS BIGINT) AS cache_creation_tokens,
         CAST(k * 37 + 100 AS BIGINT) AS duration_ms, 'os-' || CAST(k % 7 AS VARCHAR) AS os_type,
         'term-' || CAST(k % 9 AS VARCHAR) AS terminal_type, '1.0.' || CAST(k % 20 AS VARCHAR) AS client_version
  FROM ev WHERE event_type = 'purchase'),
user_prompts AS (
  SELECT {_common()}, CAST(k + 1 AS BIGINT) AS prompt_length FROM ev WHERE event_type = 'view'),
tool_events AS (
  SELECT {_common()},
         CASE WHEN event_type = 'click' THEN 'decision' ELSE 'result' END AS event_type,
         'tool-' || CAST(k % 17 AS VARCHAR) AS tool_name,
         CASE WHEN event_type = 'click' THEN (CASE WHEN k % 10 = 0 THEN 'reject' ELSE 'accept' END) END AS decision,
         CASE WHEN event_type = 'signup' THEN event_id % 10 <> 0 END AS success,
         CASE WHEN event_type = 'signup' THEN CAST(k * 13 AS BIGINT) END AS duration_ms
  FROM ev WHERE event_type IN ('click', 'signup')),
api_errors AS (
  SELECT {_common()}, {MODEL} AS model,
         '{ERROR_TEXT_HEAD}' || CAST(k % 8 AS VARCHAR) || '{ERROR_TEXT_TAIL}' AS error_message,
         CASE WHEN k % 5 = 0 THEN 'undefined' ELSE CAST(500 + k % 5 AS VARCHAR) END AS status_code,
         CAST(1 + k % 3 AS BIGINT) AS attempt, CAST(k * 7 + 50 AS BIGINT) AS duration_ms
  FROM ev WHERE event_type = 'error')"""


def with_views(body: str, extra_ctes: str = "") -> str:
    ctes = VIEWS + ("," + extra_ctes if extra_ctes else "")
    return f"WITH {ctes}\n{body}"


# -- numeric rules ---------------------------------------------------------
def exact_sum(c: str) -> str:
    """Sum of the finite costs; the text form is the shortest that reads back the same."""
    return f"SUM(CASE WHEN isfinite({c}) THEN CAST(CAST({c} AS VARCHAR) AS DECIMAL(38,15)) END)"


def or_odd(c: str, value: str) -> str:
    odd = f"FILTER (WHERE NOT isfinite({c}))"
    return f"CASE WHEN COUNT(*) {odd} > 0 THEN SUM({c}) {odd} ELSE {value} END"


def money(c: str) -> str:
    return or_odd(c, f"CAST(ROUND({exact_sum(c)}, 2) AS DOUBLE)")


def half_up(total: str, n: str, scale: int) -> str:
    """total / n for total >= 0, half-up at ``scale`` digits, in integers."""
    two = 2 * 10 ** scale
    whole, part = f"CAST(floor({total}) AS HUGEINT)", f"CAST({total} - floor({total}) AS DECIMAL(30,15))"
    return (f"CAST((CAST({two} AS HUGEINT) * {whole} + CAST(floor({part} * {two}) AS HUGEINT) + {n})"
            f" // (2 * NULLIF({n}, 0)) AS DOUBLE) / {10 ** scale}")


def avg_cost(c: str, scale: int) -> str:
    return or_odd(c, half_up(exact_sum(c), f"COUNT({c})", scale))


TOKENS = "CAST(SUM(input_tokens + output_tokens) AS BIGINT)"


# -- filters ---------------------------------------------------------------
def _pick(col: str, values) -> str:
    if values is None:
        return f"{col} IS NOT NULL"
    if len(values) == 0:
        return "FALSE"
    return f"{col} IN (" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def where(f: UsageFilters, model: bool = True) -> str:
    parts = [_pick("e.practice", f.practices), _pick("e.level", f.levels), _pick("e.location", f.locations)]
    if model:
        parts.append(_pick("x.model", f.models))
    ts = 'x."timestamp"'
    lo = f"CAST('{f.start}' AS DATE)" if f.start is not None else \
        '(SELECT CAST(MIN("timestamp") AS DATE) FROM api_requests)'
    hi = f"CAST('{f.end}' AS DATE)" if f.end is not None else \
        '(SELECT CAST(MAX("timestamp") AS DATE) FROM api_requests)'
    if f.end_day == "midnight":
        parts.append(f"{ts} BETWEEN CAST({lo} AS TIMESTAMP) AND CAST({hi} AS TIMESTAMP)")
    else:
        parts.append(f"{ts} >= CAST({lo} AS TIMESTAMP) AND {ts} < CAST({hi} + INTERVAL 1 DAY AS TIMESTAMP)")
    return " AND ".join(parts)


def page(body: str, f: UsageFilters, fact: str = "api_requests", model: bool = True, more: str = "",
         tables: str = "") -> str:
    """``body`` over ``hits``: the fact's filtered rows with their employee."""
    hits = (f"hits AS (SELECT * EXCLUDE (level, user_email), level AS lvl, user_email AS usr FROM {fact} x "
            f"JOIN employees e ON x.user_email = e.email WHERE {where(f, model)})")
    return with_views(body, ", ".join(t for t in (tables, hits, more) if t))


# -- the page ----------------------------------------------------------------
def kpi_columns() -> str:
    return f"""COUNT(DISTINCT session_id) AS total_sessions, COUNT(*) AS total_api_calls,
       {money('cost_usd')} AS total_cost, {avg_cost('cost_usd', 4)} AS avg_cost_per_call,
       {TOKENS} AS total_tokens, COUNT(DISTINCT usr) AS active_users"""


def kpi(f: UsageFilters) -> str:
    return page(f"SELECT {kpi_columns()} FROM hits", f)


def short_name(c: str) -> str:
    return f"regexp_replace(replace({c}, '{MODEL_PREFIX}', ''), '{MODEL_DATE_SUFFIX}', '', 'g')"


def model_usage(f: UsageFilters) -> str:
    return page(f"""SELECT model, COUNT(*) AS api_calls, {money('cost_usd')} AS total_cost, {short_name('model')} AS model_short
FROM hits GROUP BY model ORDER BY api_calls DESC, model""", f)


def _by(key: str, extra: str = "") -> str:
    return f"SELECT {key}, {money('cost_usd')} AS total_cost, COUNT(*) AS api_calls{extra} FROM hits GROUP BY {key}"


def cost_by_practice(f: UsageFilters) -> str:
    return page(_by("practice"), f)


def cost_share(f: UsageFilters) -> str:
    return page("""SELECT b.*, ROUND(total_cost / (SELECT SUM(total_cost) FROM b), 6) AS cost_share FROM b""", f,
                more=f"b AS ({_by('practice')})")


def daily_usage(f: UsageFilters) -> str:
    return page(f"""SELECT CAST("timestamp" AS DATE) AS day, COUNT(*) AS api_calls, {money('cost_usd')} AS daily_cost
FROM hits GROUP BY day""", f)


def daily_calls(f: UsageFilters) -> str:
    return page('SELECT CAST("timestamp" AS DATE) AS day, COUNT(*) AS api_calls FROM hits GROUP BY day', f)


HOUR_DOW = """SELECT CAST(HOUR("timestamp") AS INTEGER) AS hour, CAST(DAYOFWEEK("timestamp") + 1 AS INTEGER) AS dow,
       COUNT(*) AS calls FROM hits GROUP BY ALL"""


def hour_dow(f: UsageFilters) -> str:
    return page(HOUR_DOW, f)


def usage_heatmap(f: UsageFilters) -> str:
    cells = ",\n       ".join(
        f"CAST(COALESCE(SUM(calls) FILTER (WHERE hour = {h}), 0) AS BIGINT) AS h{h:02d}" for h in range(24)
    )
    names = " ".join(f"WHEN {k} THEN '{v}'" for k, v in WEEKDAY_NAMES.items())
    return page(f"""SELECT CAST((dow + 5) % 7 + 1 AS INTEGER) AS day_order, CASE dow {names} END AS day_name,
       {cells}
FROM hd GROUP BY dow""", f, more=f"hd AS ({HOUR_DOW})")


def tokens_by_level(f: UsageFilters) -> str:
    total = "CAST(SUM(input_tokens + output_tokens) AS DECIMAL(38,15))"
    return page(f"""SELECT lvl AS level, {half_up(total, 'COUNT(input_tokens + output_tokens)', 0)} AS avg_tokens,
       {avg_cost('cost_usd', 5)} AS avg_cost FROM hits GROUP BY lvl""", f)


def tool_success(f: UsageFilters, top: int = 12) -> str:
    return page(f"""SELECT tool_name, COUNT(*) AS uses,
       CAST((2000 * COUNT(*) FILTER (WHERE success) + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / 10 AS success_rate
FROM hits WHERE event_type = 'result' GROUP BY tool_name ORDER BY uses DESC, tool_name LIMIT {top}""", f, "tool_events", False)


def _errors(top: int) -> str:
    return f"""te AS (SELECT model, error_message, COUNT(*) AS occurrences FROM hits GROUP BY ALL
ORDER BY occurrences DESC, model NULLS LAST, error_message NULLS LAST LIMIT {top})"""


def top_errors(f: UsageFilters, top: int = 10) -> str:
    return page("SELECT * FROM te", f, "api_errors", False, _errors(top))


def top_errors_free_text() -> str:
    """``standin.free_text_errors`` restated."""
    free = """free_errors AS (
  SELECT * REPLACE (CASE WHEN CAST(event_id AS BIGINT) % 3 <> 0 THEN error_message || ' (request ' || event_id || ')'
                    ELSE error_message END AS error_message) FROM api_errors)"""
    return page("SELECT * FROM te", UsageFilters(), "free_errors", False, _errors(10), free)


LABEL = "left(error_message, 45) || '...'"


def error_label_totals(f: UsageFilters, top: int = 10) -> str:
    return page(f"SELECT *, {LABEL} AS label, SUM(occurrences) OVER (PARTITION BY {LABEL}) AS label_total FROM te",
                f, "api_errors", False, _errors(top))


def error_labels(f: UsageFilters, top: int = 10) -> str:
    return page(f"SELECT *, {LABEL} AS label FROM te", f, "api_errors", False, _errors(top))


def cost_by_location(f: UsageFilters) -> str:
    return page(_by("location", ", COUNT(DISTINCT email) AS engineers"), f)


def top_engineers(f: UsageFilters, top: int = 20) -> str:
    return page(f"""SELECT full_name, practice, lvl AS level, location, COUNT(DISTINCT session_id) AS sessions,
       COUNT(*) AS api_calls, {money('cost_usd')} AS total_cost, {TOKENS} AS total_tokens
FROM hits GROUP BY full_name, practice, lvl, location
ORDER BY total_cost DESC NULLS LAST, full_name, practice, lvl, location LIMIT {top}""", f)


def filter_options() -> str:
    return with_views("""
SELECT DISTINCT * FROM (
  SELECT 'practice' AS option, practice AS value FROM employees
  UNION ALL SELECT 'level', level FROM employees
  UNION ALL SELECT 'location', location FROM employees
  UNION ALL SELECT 'model', model FROM api_requests) o
ORDER BY option, value NULLS LAST""")


def date_bounds() -> str:
    return with_views("""
SELECT CAST(MIN("timestamp") AS DATE) AS min_date, CAST(MAX("timestamp") AS DATE) AS max_date
FROM api_requests""")


def user_pseudonym() -> str:
    return with_views("SELECT email, sha256(email) AS user_id FROM employees")


# -- decode round trip (facts -> envelopes -> text -> decode) ---------------
FACT_COLUMNS = {
    "api_requests": "event_id, session_id, user_email, {ts}, model, cost_usd, input_tokens, output_tokens, "
                    "cache_read_tokens, cache_creation_tokens, duration_ms, os_type, terminal_type, client_version",
    "user_prompts": "event_id, session_id, user_email, {ts}, prompt_length",
    "tool_events": "event_id, session_id, user_email, {ts}, event_type, tool_name, decision, success, duration_ms",
    "api_errors": "event_id, session_id, user_email, {ts}, model, error_message, status_code, attempt, duration_ms",
}
MS_TS = "date_trunc('millisecond', \"timestamp\") AS \"timestamp\""


def decoded_fact(table: str) -> str:
    return with_views(f"SELECT {FACT_COLUMNS[table].format(ts=MS_TS)} FROM {table}")


BODY = {kind: body for body, kind in BODY_KIND.items()}
_KIND_COUNTS = f"""
SELECT 'api_request' AS kind, '{BODY["api_request"]}' AS body, COUNT(*) AS n FROM api_requests
UNION ALL SELECT 'user_prompt', '{BODY["user_prompt"]}', COUNT(*) FROM user_prompts
UNION ALL SELECT 'tool_decision', '{BODY["tool_decision"]}', COUNT(*) FROM tool_events WHERE event_type = 'decision'
UNION ALL SELECT 'tool_result', '{BODY["tool_result"]}', COUNT(*) FROM tool_events WHERE event_type = 'result'
UNION ALL SELECT 'api_error', '{BODY["api_error"]}', COUNT(*) FROM api_errors"""


def route_counts() -> str:
    return with_views("SELECT kind, n AS events FROM kc WHERE n > 0", f"kc AS ({_KIND_COUNTS})")


def event_counts() -> str:
    return with_views("SELECT body, n AS events FROM kc WHERE n > 0 ORDER BY events DESC, body",
                      f"kc AS ({_KIND_COUNTS})")


def ingest_counts() -> str:
    """``catalog._dirty_lines``: one line per event; by event_id % 14 a 1, 7, 8 or 9 spoils the
    line, a 2 or 10 the message, a 3 the body, a 4 puts a number beside the event, a 5 single-quotes
    the message, a 6 cuts the log event's object, an 11 or 12 leaves no list."""
    tables = ("api_requests", "user_prompts", "tool_events", "api_errors")
    bad, skipped = "(1, 7, 8, 9, 11, 12)", "(2, 3, 5, 6, 10)"
    m = "CAST(event_id AS BIGINT) % 14"
    alle = " UNION ALL ".join(f"SELECT {m} AS m FROM {t}" for t in tables)
    counts = " UNION ALL ".join(f"SELECT '{t}' AS counter, COUNT(*) AS n FROM {t} WHERE {m} NOT IN {bad} AND {m} NOT IN {skipped}"
                                for t in tables)
    return with_views(f"""{counts}
UNION ALL SELECT 'skipped', COUNT(*) FROM alle WHERE m = 4 OR m IN {skipped}
UNION ALL SELECT 'total_events', COUNT(*) FILTER (WHERE m NOT IN {bad}) + COUNT(*) FILTER (WHERE m = 4) FROM alle
UNION ALL SELECT 'malformed_lines', COUNT(*) FROM alle WHERE m IN {bad}""", f"alle AS ({alle})")


def stream_load() -> str:
    """Two sources into one store: twice the rows."""
    return with_views("""
SELECT 'api_requests' AS fact_table, 2 * COUNT(*) AS "rows" FROM api_requests
UNION ALL SELECT 'user_prompts', 2 * COUNT(*) FROM user_prompts
UNION ALL SELECT 'tool_events', 2 * COUNT(*) FROM tool_events
UNION ALL SELECT 'api_errors', 2 * COUNT(*) FROM api_errors""")


def total_cost() -> str:
    return with_views(f"SELECT COALESCE({money('cost_usd')}, 0) AS total_cost FROM api_requests")


def envelope_pack() -> str:
    return with_views("""
SELECT CAST(year(t) AS INTEGER) AS year, CAST(month(t) AS INTEGER) AS month, CAST(day(t) AS INTEGER) AS day,
       COUNT(*) AS events, MIN(epoch_ms(date_trunc('millisecond', t))) AS first_ms,
       MAX(epoch_ms(date_trunc('millisecond', t))) AS last_ms
FROM alle GROUP BY 1, 2, 3""", """alle AS (
  SELECT "timestamp" AS t FROM api_requests UNION ALL SELECT "timestamp" FROM user_prompts
  UNION ALL SELECT "timestamp" FROM tool_events UNION ALL SELECT "timestamp" FROM api_errors)""")


def safe_casts() -> str:
    """``standin.DIRTY_NUMBERS`` by event_id: the values Python's float and int give."""
    floats = " ".join(f"WHEN {i} THEN {f}" for i, (_, f, _) in enumerate(DIRTY_NUMBERS))
    ints = " ".join(f"WHEN {i} THEN {n}" for i, (_, _, n) in enumerate(DIRTY_NUMBERS))
    pick = f"CASE event_id % {2 * len(DIRTY_NUMBERS)}"
    return f"""
SELECT event_id, CAST({pick} {ints} ELSE trunc(value) END AS BIGINT) AS value_int,
       CAST({pick} {floats} ELSE value END AS DOUBLE) AS value_float,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_int,
       date_trunc('millisecond', ts) AS ts_ms, value > 50 AS flag
FROM events"""


def model_short_name() -> str:
    return with_views(f"SELECT DISTINCT model, {short_name('model')} AS model_short FROM api_requests")


def extreme_costs() -> str:
    """``standin.extreme_requests`` restated; the same row for every plan shape. Of costs of
    any size, those of 1e300 decide every digit of a double: their number with the exponent,
    and 30 digits of its quotient by the count."""
    odd = """{name} AS (
  SELECT * REPLACE (CASE CAST(event_id AS BIGINT) % {of} WHEN 0 THEN 0.0000499999 WHEN 1 THEN 2e10 {more} ELSE cost_usd / 1e12 END AS cost_usd,
                    3000000000 AS input_tokens) FROM api_requests)"""
    huge = "CAST(COUNT(*) FILTER (WHERE cost_usd = 1e300) AS HUGEINT)"
    shapes = "(VALUES ('broadcast'), ('shuffle'), ('shared')) s(shape)"
    any_hits = page("", UsageFilters(), "any_requests").split("hits AS ", 1)[1].strip()
    return page(f"""SELECT 'wide' AS sizes, shape, k.* FROM (SELECT {kpi_columns()} FROM hits) k, {shapes}
UNION ALL
SELECT 'any', shape, k.* FROM (
  SELECT COUNT(DISTINCT session_id), COUNT(*), CAST(CAST({huge} AS VARCHAR) || 'e300' AS DOUBLE),
         CAST(CAST({huge} * CAST(1000000000000000000000000000000 AS HUGEINT) // COUNT(cost_usd) AS VARCHAR) || 'e270' AS DOUBLE),
         {TOKENS}, COUNT(DISTINCT usr) FROM any_hits) k, {shapes}""", UsageFilters(), "odd_requests",
                tables=odd.format(name="odd_requests", of=5, more="") + ", "
                + odd.format(name="any_requests", of=8, more="WHEN 2 THEN 1e300 WHEN 3 THEN 1e23 WHEN 4 THEN 1e-300"),
                more="any_hits AS " + any_hits)


def employee_append() -> str:
    """The first load holds the even customers; a second load of all, under other names,
    adds the odd ones only."""
    return with_views("""SELECT email, CASE WHEN CAST(email AS BIGINT) % 2 = 0 THEN full_name ELSE full_name || '-later' END AS full_name,
       practice, level, location FROM employees""")


def decode_roundtrip() -> str:
    cols = f"event_id, session_id, user_email, {MS_TS}"
    return with_views(f"""
SELECT 'api_request' AS kind, {cols} FROM api_requests
UNION ALL SELECT 'user_prompt', {cols} FROM user_prompts
UNION ALL SELECT CASE WHEN event_type = 'decision' THEN 'tool_decision' ELSE 'tool_result' END, {cols}
          FROM tool_events
UNION ALL SELECT 'api_error', {cols} FROM api_errors""")


def employee_dim() -> str:
    """Names hold quotes, commas, a newline and a backslash on the way (``catalog._employee_dim``)."""
    return with_views("""SELECT email, full_name || ' "Bo", Jr' || chr(10) || 'x' || chr(92) AS full_name, practice, level, location
FROM employees""")
