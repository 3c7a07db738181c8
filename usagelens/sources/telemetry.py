"""Raw log-batch files (JSON lines) as a DataFrame of text lines."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession


def spread(scan: DataFrame, min_tasks: int | None = None) -> DataFrame:
    """Round-robin the rows of a raw scan over at least ``min_tasks`` tasks (default:
    the cluster's cores) when the input yields fewer splits, e.g. one unsplittable
    compressed file or a file with a single row group. Input that already splits
    widely is returned unchanged, so large inputs pay no extra shuffle.

    Only for plain scans (no exchange below): counting partitions plans the input."""
    want = min_tasks or scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= want:
        return scan
    return scan.repartition(want)


def read_log_lines(spark: SparkSession, paths: str | Sequence[str], spread_input: bool | str = True) -> DataFrame:
    """One row per line (column ``value``); files are split across tasks, and
    compressed files are read by their codec. Folders are read recursively.

    ``spread_input``: ``True`` spreads the lines when the input yields fewer splits
    than the cluster has cores; ``"always"`` rebalances them in any case (REBALANCE
    without keys: AQE cuts the lines into tasks of the advisory size), for inputs
    where one unsplittable file (gzip) holds a large share of all lines, so that
    its decode does not run in the single task that reads it; ``False`` keeps the
    read splits."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = spark.read.option("recursiveFileLookup", "true").text(paths)
    if spread_input == "always":
        return lines.hint("rebalance")
    return spread(lines) if spread_input else lines
