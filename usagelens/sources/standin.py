"""Stand-in telemetry tables over the driver's parquet tables.

The given tables hold no telemetry, so the employee dimension and the four fact
tables are defined as views over ``customer ⋈ nation ⋈ region`` and ``events``.
Every value is a pure function of one input row, so the views grow with the input
and the DuckDB oracle can define the very same views (``plans/oracle.py``).

| event_type | fact table    | kind          |
|------------|---------------|---------------|
| purchase   | api_requests  | api_request   |
| view       | user_prompts  | user_prompt   |
| click      | tool_events   | tool_decision |
| signup     | tool_events   | tool_result   |
| error      | api_errors    | api_error     |
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.functions.labels import MODEL_PREFIX
from usagelens.schemas import FACT_SCHEMAS
from usagelens.tables import UsageTables

# Fixed values of the stand-in mapping: model names carry the page's vendor prefix and a
# date suffix, so that shortening them has something to do.
MODEL_HEAD = f"{MODEL_PREFIX}model-"
MODEL_TAIL = "-202510"
ERROR_TEXT_HEAD = "error message variant number "
ERROR_TEXT_TAIL = " with a tail that runs past the label cut"


# Text an attribute may hold, with Python's float() and int(float()) of it (or the
# defaults); used for every second run of event ids.
DIRTY_NUMBERS = [
    (" 12 ", "12.0", "12"), ("1_000", "1000.0", "1000"), ("12d", "0.0", "0"), ("3000000000", "3000000000.0", "3000000000"),
    ("1e3", "1000.0", "1000"), ("-12.7", "-12.7", "-12"), ("", "0.0", "0"), ("1__0", "0.0", "0"), ("0x10", "0.0", "0"),
    ("_1", "0.0", "0"), (".5", "0.5", "0"), ("1_0.2_5e1_0", "102500000000.0", "102500000000"),
]


def dirty_number(event_id: Column, clean: Column) -> Column:
    """The dirty text by ``event_id % (2 * n)``; beyond n the clean text."""
    m = event_id % (2 * len(DIRTY_NUMBERS))
    out = clean
    for i, (text, _, _) in enumerate(DIRTY_NUMBERS):
        out = F.when(m == i, F.lit(text)).otherwise(out)
    return out


def extreme_requests(requests: DataFrame, any_size: bool = False) -> DataFrame:
    """Requests whose costs are far apart (just below a rounding edge, beyond 10^10, below
    10^-9; with ``any_size`` also 1e300, 1e23 and 1e-300) and whose token counts pass 32 bits."""
    m = F.col("event_id").cast("bigint") % (8 if any_size else 5)
    cost = F.when(m == 0, F.lit(0.0000499999)).when(m == 1, F.lit(2e10))
    if any_size:
        cost = cost.when(m == 2, F.lit(1e300)).when(m == 3, F.lit(1e23)).when(m == 4, F.lit(1e-300))
    cost = cost.otherwise(F.col("cost_usd") / 1e12)
    return requests.withColumn("cost_usd", cost).withColumn("input_tokens", F.lit(3_000_000_000).cast("bigint"))


def free_text_errors(errors: DataFrame) -> DataFrame:
    """Errors of which two thirds have a message of their own: a request id is part of it."""
    own = F.col("event_id").cast("bigint") % 3 != 0
    return errors.withColumn("error_message", F.when(own, F.concat("error_message", F.lit(" (request "), "event_id", F.lit(")")))
                             .otherwise(F.col("error_message")))


# Declared schemas of the driver tables read here: no footer sampling per query,
# and a changed file type fails loudly instead of changing the plan.
DRIVER_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if name in DRIVER_SCHEMAS:
        return spark.read.schema(DRIVER_SCHEMAS[name]).parquet(path)
    return spark.read.parquet(path)


def standin_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer")
    # nation and region are code tables (25 and 5 rows at every scale); no hint:
    # Spark's size check (autoBroadcastJoinThreshold on the scanned file size)
    # broadcasts them, and would not if they ever grew past it.
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    key = F.col("c_custkey")
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            key.cast("string").alias("email"),
            F.col("c_name").alias("full_name"),
            F.col("c_mktsegment").alias("practice"),
            F.concat(F.lit("L"), (F.lit(1) + key % 10).cast("string")).alias("level"),
            F.col("r_name").alias("location"),
        )
    )


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def _common() -> list[Column]:
    return [
        F.col("event_id").cast("string").alias("event_id"),
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.to_date("ts").cast("string")).alias("session_id"),
        F.col("user_id").cast("string").alias("user_email"),
        F.col("ts").cast("timestamp_ntz").alias("timestamp"),
    ]


def _model(k: Column) -> Column:
    m = (k % 5).cast("string")
    return F.concat(F.lit(MODEL_HEAD), m, F.lit(MODEL_TAIL), m)


def standin_facts(events: DataFrame) -> dict[str, DataFrame]:
    k = _k()
    et = F.col("event_type")
    requests = events.where(et == "purchase").select(
        *_common(),
        _model(k).alias("model"),
        F.col("value").cast("double").alias("cost_usd"),
        (k * 10).alias("input_tokens"),
        (k + 1).alias("output_tokens"),
        (k * 100).alias("cache_read_tokens"),
        (k * 20).alias("cache_creation_tokens"),
        (k * 37 + 100).alias("duration_ms"),
        F.concat(F.lit("os-"), (k % 7).cast("string")).alias("os_type"),
        F.concat(F.lit("term-"), (k % 9).cast("string")).alias("terminal_type"),
        F.concat(F.lit("1.0."), (k % 20).cast("string")).alias("client_version"),
    )
    prompts = events.where(et == "view").select(*_common(), (k + 1).alias("prompt_length"))
    is_click = et == "click"
    tools = events.where(et.isin("click", "signup")).select(
        *_common(),
        F.when(is_click, "decision").otherwise("result").alias("event_type"),
        F.concat(F.lit("tool-"), (k % 17).cast("string")).alias("tool_name"),
        F.when(is_click, F.when(k % 10 == 0, "reject").otherwise("accept")).alias("decision"),
        F.when(~is_click, F.col("event_id") % 10 != 0).alias("success"),
        F.when(~is_click, k * 13).alias("duration_ms"),
    )
    errors = events.where(et == "error").select(
        *_common(),
        _model(k).alias("model"),
        F.concat(F.lit(ERROR_TEXT_HEAD), (k % 8).cast("string"), F.lit(ERROR_TEXT_TAIL)).alias("error_message"),
        F.when(k % 5 == 0, "undefined").otherwise((F.lit(500) + k % 5).cast("string")).alias("status_code"),
        (F.lit(1) + k % 3).alias("attempt"),
        (k * 7 + 50).alias("duration_ms"),
    )
    out = {"api_requests": requests, "user_prompts": prompts, "tool_events": tools, "api_errors": errors}
    return {name: df.select([F.col(f.name).cast(f.dataType) for f in FACT_SCHEMAS[name].fields])
            for name, df in out.items()}


def standin_tables(spark: SparkSession, sf_dir: str) -> UsageTables:
    facts = standin_facts(read_table(spark, sf_dir, "events"))
    return UsageTables(
        employees=standin_employees(spark, sf_dir),
        **facts,
    )
