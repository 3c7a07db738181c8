"""Facts and dimension stored bucketed on the email (J1-J3 with a large dimension).

``write_buckets`` writes the tables as catalog tables in ``buckets`` hash buckets of ``(email, bucket_salt)``,
facts also by day. A page over them (``bucketed_tables``) that cannot broadcast the dimension
aggregates and joins inside the buckets: neither side is shuffled, however large.

A hot user would fill one bucket. Emails with more than one bucket's share of a fact table (fewer
than ``buckets`` of each, by definition) are cut: their rows get a salt by event, as many
as the bucket shares they fill, and the dimension has a row for each salt, at most
``2 * buckets`` more rows a fact table. Every other row has salt 0. Parts are additive, so the
rollups need no other change. Rows without an email, which join nothing, are spread too.

The tables are a copy of what the facts held when they were written; write them again after a
load. ``facts`` names the fact tables to store; the others stay as they were given. Copies of one
event (same id and time) share a salt.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.operators.star import SALT
from usagelens.schemas import FACT_SCHEMAS
from usagelens.session import stage_table
from usagelens.tables import UsageTables


def hot_emails(facts: Sequence[DataFrame], buckets: int) -> DataFrame:
    """(hot_email, salts): emails that fill more than one bucket of a fact table, and how many."""
    found = []
    for fact in facts:
        per = stage_table(fact.where("user_email IS NOT NULL").groupBy("user_email").agg(F.count(F.lit(1)).alias("n")), "per-email")
        total = per.agg(F.sum("n")).first()[0] or 0
        found.append(per.where(F.col("n") * buckets > total)
                     .select(F.col("user_email").alias("hot_email"), F.ceil(F.col("n") * buckets / F.lit(max(total, 1))).alias("salts")))
    return stage_table(reduce(DataFrame.unionByName, found).groupBy("hot_email").agg(F.max("salts").alias("salts")), "hot-emails")


def write_buckets(spark: SparkSession, tables: UsageTables, name: str, path: str, buckets: int = 64,
                  facts: Sequence[str] = tuple(FACT_SCHEMAS)) -> None:
    """Write the dimension and ``facts`` as tables ``<name>_<table>`` under ``path``."""
    hot = hot_emails([tables.fact(t) for t in facts], buckets)  # fewer than len(facts) * buckets rows

    def save(frame: DataFrame, table: str, email: str, *days: str) -> None:
        writer = (frame.repartition(buckets, email, SALT).write.mode("overwrite").format("parquet")
                  .option("path", f"{path.rstrip('/')}/{table}").bucketBy(buckets, email, SALT).sortBy(email))
        (writer.partitionBy(*days) if days else writer).saveAsTable(f"{name}_{table}")

    last = F.coalesce(F.col("salts"), F.lit(1)) - 1
    dim = tables.employees.drop(SALT).join(F.broadcast(hot), F.col("email") == F.col("hot_email"), "left")
    dim = dim.withColumn(SALT, F.explode(F.sequence(F.lit(0), last.cast("int"))))
    save(dim.drop("hot_email", "salts"), "employees", "email")
    for t in facts:
        rows = tables.fact(t).drop(SALT).join(F.broadcast(hot), F.col("user_email") == F.col("hot_email"), "left")
        salts = F.when(F.col("user_email").isNull(), F.lit(buckets)).otherwise(F.coalesce("salts", F.lit(1)))
        rows = rows.withColumn(SALT, F.pmod(F.xxhash64("event_id", "timestamp"), salts).cast("int")).drop("hot_email", "salts")
        save(rows.withColumn("event_date", F.to_date("timestamp")), t, "user_email", "event_date")


def bucketed_tables(spark: SparkSession, tables: UsageTables, name: str,
                    facts: Sequence[str] = tuple(FACT_SCHEMAS)) -> UsageTables:
    """``tables`` with the dimension and ``facts`` read from what ``write_buckets`` stored."""
    return replace(tables, employees=spark.table(f"{name}_employees"),
                   **{t: spark.table(f"{name}_{t}") for t in facts})
