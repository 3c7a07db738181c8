"""Session helpers: the settings the engine expects, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every query relies on for its semantics (not tuning): event times are
# zone-less wall clock, so the session zone must not shift them.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Tuning defaults for local runs (tests, bench). A cluster keeps its own values:
# ``build_session`` is never called by library code.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.shuffle.partitions": "8",
}


def build_session(master: str | None = None, app: str = "usagelens", extra: dict | None = None) -> SparkSession:
    """A session for tests and the bench. Sets a checkpoint folder only when none is named."""
    builder = SparkSession.builder.master(master or os.environ.get("USAGELENS_MASTER", "local[8]")).appName(app)
    for k, v in {**LOCAL_CONF, **SEMANTIC_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in SEMANTIC_CONF.items():
        spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Read from the session (``spark.checkpoint.dir`` or the context's folder). Only a
    local-mode session without one gets a fresh scratch folder; a cluster without a
    shared folder is an error, since a machine-local folder would not survive the
    loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        named = tempfile.mkdtemp(prefix="usagelens-ckpt-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir() or named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, for staged outputs."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/usagelens-stage/{name}-{uuid.uuid4().hex[:12]}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it
    back: later plans scan a plain table (column pruning, pushed filters) instead of
    recomputing ``df``, and a lost executor re-reads files instead of recomputing."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
