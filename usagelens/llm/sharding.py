"""Contiguous shards of near-equal byte size (DataFrame functions only).

Documents are put in one global order, (doc_id with null first, text checksum, size).
Range partitions of that order give per-partition byte totals; their prefix sum is
each partition's base, and a running sum inside the partition gives every document's
byte interval. A document goes to the shard that holds the middle of its interval
when the whole corpus is cut at equal byte targets, so shards are contiguous runs and
each is within one document of its target.

Rows equal in (doc_id, checksum, size) are counted before anything is ordered, so
thousands of repeated rows travel as one; they take neighbouring places, and are unfolded
in chunks that are dealt out. The ordered
keys are staged once: range bounds come from a sample, and from then on they are fixed
whatever is re-run. No row holds text after the first projection.

Cases: a null text has size 1 (0 bytes plus 1) and checksum of the empty text; an
empty table gives an empty result; all columns of the input but ``doc_id`` and
``text`` are ignored, so clashing names cannot occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from usagelens.llm.common import stage, text_or_empty, unfold, width

SHARDS = 16
KEYS_PER_TASK = 500_000


def byte_shards(docs: DataFrame, shards: int = SHARDS, keys_per_task: int = KEYS_PER_TASK) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard; one row per input row."""
    spark = docs.sparkSession
    keys = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("t"))
            .select("doc_id", (F.octet_length("t") + F.lit(1)).cast("long").alias("size"),
                    F.crc32(F.col("t").cast("binary")).alias("text_crc32"))
            .groupBy("doc_id", "text_crc32", "size").agg(F.count(F.lit(1)).alias("copies")))
    keys = stage(keys, "shard-keys")
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_crc32"), F.col("size")]
    n = width(spark, keys.count(), keys_per_task)
    ranged = stage(keys.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), "shard-ranges")

    # One row per partition: bytes and rows before it, and the grand total.
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    every = W.orderBy("part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    totals = ranged.groupBy("part").agg(F.sum(F.col("size") * F.col("copies")).alias("b"), F.sum("copies").alias("r"))
    bases = totals.select("part", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("base_b"),
                          F.coalesce(F.sum("r").over(before), F.lit(0)).alias("base_r"),
                          F.sum("b").over(every).alias("total"))

    inside = W.partitionBy("part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    placed = (ranged
              .withColumn("pre_b", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(inside), F.lit(0)))
              .withColumn("pre_r", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
              .join(bases, "part"))
    one = unfold(placed.select(
        "doc_id", "size", "text_crc32", "total", "copies",
        (F.col("base_b") + F.col("pre_b")).alias("first_byte"), (F.col("base_r") + F.col("pre_r")).alias("first_row")),
        "doc_id", "text_crc32", "size")
    start = F.col("first_byte") + F.col("copy") * F.col("size")
    cut = one.select("doc_id", "size", "text_crc32", (F.col("first_row") + F.col("copy")).alias("row_no"),
                     F.expr(f"cast(({2 * shards} * cast(first_byte + copy * size as decimal(24,0)) + {shards} * size)"
                            f" div (2 * total) as int)").alias("shard"), start.alias("start_byte"))
    # First row of each shard (at most ``shards`` rows): slots count from there.
    firsts = cut.groupBy("shard").agg(F.min("row_no").alias("first_no"))
    return cut.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("row_no") - F.col("first_no")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        "start_byte")
