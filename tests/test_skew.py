"""One user holding a third of all rows: both join shapes stay exact, and the shuffle
shape collapses the hot user before anything moves."""


from pyspark.sql import functions as F

from usagelens.operators.filters import UsageFilters
from usagelens.operators.rollups import UsagePage
from usagelens.schemas import EMPLOYEES, FACT_SCHEMAS
from usagelens.tables import UsageTables

N = 30000


def skewed_tables(spark):
    ids = spark.range(N).select(F.col("id"))
    hot = F.col("id") % 3 == 0                       # a third of all rows: one user
    user = F.when(hot, F.lit("hot")).otherwise((F.col("id") % 997).cast("string"))
    req = ids.select(
        F.col("id").cast("string").alias("event_id"),
        F.concat(user, F.lit("-"), (F.col("id") % 50).cast("string")).alias("session_id"),
        user.alias("user_email"),
        (F.lit("2026-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") % 86400))
        .alias("timestamp"),
        F.concat(F.lit("m"), (F.col("id") % 3).cast("string")).alias("model"),
        (F.col("id") % 100 / 100).cast("double").alias("cost_usd"),
        (F.col("id") % 7).cast("int").alias("input_tokens"),
        F.lit(1).alias("output_tokens"),
        *[F.lit(0).alias(c) for c in ("cache_read_tokens", "cache_creation_tokens", "duration_ms")],
        *[F.lit("").alias(c) for c in ("os_type", "terminal_type", "client_version")],
    )
    req = req.select([F.col(f.name).cast(f.dataType) for f in FACT_SCHEMAS["api_requests"].fields])
    emp = spark.createDataFrame(
        [("hot", "Hot User", "ML", "L1", "Paris")] + [(str(i), f"U{i}", "Data", f"L{i % 10 + 1}", "Rome")
                                                      for i in range(997)], EMPLOYEES)
    empty = {n: spark.createDataFrame([], s) for n, s in FACT_SCHEMAS.items() if n != "api_requests"}
    return UsageTables(employees=emp, api_requests=req.repartition(6), **empty)


def test_hot_user_both_shapes(spark):
    t = skewed_tables(spark)
    f = UsageFilters(start="2026-01-01", end="2026-01-02")
    b, s = UsagePage(t, f, broadcast=True), UsagePage(t, f, broadcast=False)
    for m in ("kpi", "cost_by_practice", "top_engineers", "tokens_by_level", "cost_by_location"):
        assert sorted(map(tuple, getattr(b, m)().collect())) == sorted(map(tuple, getattr(s, m)().collect())), m
    kpi = b.kpi().first()
    assert kpi.total_api_calls == N and kpi.active_users == 998
    hot = [r for r in b.top_engineers().collect() if r.full_name == "Hot User"][0]
    assert hot.api_calls == N // 3 and hot.sessions == 50


def test_hot_user_collapses_before_the_join(spark):
    t = skewed_tables(spark)
    page = UsagePage(t, UsageFilters(start="2026-01-01", end="2026-01-02"), broadcast=False)
    joined = page.joined("api_requests", {}, {"n": F.lit(1).cast("long")}, ["practice"])
    rows = joined.collect()
    assert len(rows) == 998                                   # one row per user reaches the join
    assert [r.n for r in rows if r.email == "hot"] == [N // 3]


def test_copies_of_one_event_spread_over_range_partitions(spark):
    """A third of all events are exact copies of one event: the range shuffle of
    envelope packing still cuts them across tasks, and no copy is lost."""
    from usagelens.operators.envelopes import pack_envelopes, range_ordered

    ids = spark.range(N)
    copy = F.col("id") % 3 == 0
    events = ids.select(
        F.when(copy, F.lit("2026-01-01 12:00:00")).otherwise(
            F.concat(F.lit("2026-01-01 "), F.lpad((F.col("id") % 24).cast("string"), 2, "0"), F.lit(":00:00")))
        .cast("timestamp_ntz").alias("event_time"),
        F.when(copy, F.lit("same")).otherwise(F.col("id").cast("string")).alias("log_id"),
        F.when(copy, F.lit('{"body":"x"}')).otherwise(F.col("id").cast("string")).alias("message"),
    ).repartition(6)
    per_task = [r["count"] for r in range_ordered(events, 6)
                .where(F.col("log_id") == "same").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == N // 3 and len(per_task) >= 2
    env = pack_envelopes(events, size=10, partitions=6)
    assert env.select(F.sum(F.size("logEvents"))).first()[0] == N


def test_hot_day_is_cut_into_several_files(spark, scratch):
    """Most rows on one day: the rebalanced write cuts that day's table folder into
    several files (tasks) instead of one, and keeps every row."""
    import os

    from conftest import SF_SMALL
    from usagelens.operators import decode as D
    from usagelens.operators.envelopes import encode_facts, pack_envelopes, write_envelopes
    from usagelens.sources import store
    from usagelens.sources.standin import standin_tables
    from usagelens.sources.telemetry import read_log_lines

    write_envelopes(pack_envelopes(encode_facts(standin_tables(spark, SF_SMALL))), f"{scratch}/logs")
    decoded = D.decode_lines(read_log_lines(spark, f"{scratch}/logs"))
    day = decoded.where(F.col("kind") == "api_request").agg(F.min(F.to_date("timestamp"))).first()[0]
    # The busy day arrives from many input tasks, as it would from many files: AQE
    # can cut a partition only between the outputs of different map tasks.
    # Copies get their own event ids (identical rows would shrink to nothing in
    # the compressed shuffle, which AQE measures).
    hot = (decoded.where(F.to_date("timestamp") == F.lit(day))
           .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(200))))
           .withColumn("event_id", F.concat("event_id", F.lit("-"), F.sha2(F.col("_copy").cast("string"), 256)))
           .drop("_copy").repartition(8))
    rows = decoded.unionByName(hot)
    keys = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize"]
    old = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "8k")
    try:
        store.write_facts(rows, f"{scratch}/db", "hot")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    folder = f"{scratch}/db/facts/table=api_requests/event_date={day.isoformat()}/load_id=hot"
    assert sum(f.endswith(".parquet") for f in os.listdir(folder)) > 1
    want = rows.where(F.col("kind") == "api_request").count()
    assert store.read_facts(spark, f"{scratch}/db", "api_requests").count() == want
