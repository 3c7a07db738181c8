"""Helpers the operators share: table reads, staged tables, shipping code to executors."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.session import scratch_path

TEXTS_PER_BATCH = 1000
COPIES_PER_ROW = 4096
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application (as ``--py-files`` does):
    Python stages import their functions from it wherever the driver was started."""
    # Whole texts go through Arrow batches: Spark's default of 10,000 rows a batch would
    # hold too many long ones at once. A session that set its own number keeps it.
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, str(TEXTS_PER_BATCH))
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(root):
        fd, path = tempfile.mkstemp(prefix="usagelens-", suffix=".zip")
        with os.fdopen(fd, "wb") as f, zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(root):
                for n in sorted(names):
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.join("usagelens", os.path.relpath(full, root)))
        sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def stage(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back.

    Later plans scan the files instead of recomputing ``df``, values that depend on
    the run's partitioning are fixed from here on, and a lost executor costs a
    re-read."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions_for(spark: SparkSession) -> int:
    """The session's shuffle width, for operators that name a partition count."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def width(spark: SparkSession, rows: int, per_task: int) -> int:
    """Tasks for ``rows`` light rows, ``per_task`` each at most, and no fewer than the
    session's shuffle width."""
    return max(partitions_for(spark), -(-rows // per_task))


def unfold(df: DataFrame, *key: str) -> DataFrame:
    """A row for each of a row's ``copies``, numbered in ``copy`` from 0. Rows of many are cut
    into chunks of COPIES_PER_ROW, which are dealt out by ``key`` (unique in ``df``) and chunk,
    so no task unfolds one key's copies alone."""
    whole = F.lit(COPIES_PER_ROW).cast("long")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    first = F.col("__chunk") * whole
    return (df.withColumn("__chunk", F.explode(F.sequence(zero, F.floor((F.col("copies") - one) / whole))))
            .repartition(partitions_for(df.sparkSession), *key, "__chunk")
            .withColumn("copy", F.explode(F.sequence(first, F.least(first + whole, F.col("copies")) - one))).drop("__chunk"))


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))
