"""Incremental load of new log files with Structured Streaming.

The file source picks up files not seen before (its checkpoint remembers them), each
micro-batch is decoded as a batch load is, and ``foreachBatch`` writes the four tables.
``availableNow`` processes everything present, in bounded micro-batches, then stops; a
later run, in this or another application, adds only files that arrived since.

What makes a restart exact lies beside the store, under ``<root>/_stream/<name>``: the
checkpoint, the source folder the name belongs to (another one is refused), and the
counts of every batch. A batch's ``load_id`` is made of the name, the checkpoint's own id
and the batch number: a batch replayed after a failure replaces what it wrote before
(dynamic partition overwrite), and no other stream or source can touch it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQuery

from usagelens.operators import decode as D
from usagelens.sources.parts import fill_parts
from usagelens.sources.store import path_exists, stored_rows, write_facts


def stream_folder(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/_stream/{name}"


def _own(spark: SparkSession, root: str, name: str, source_dir: str) -> None:
    """Bind ``name`` to its source folder, or refuse another one."""
    path, source = f"{stream_folder(root, name)}/source", source_dir.rstrip("/")
    if not path_exists(spark, f"{path}/_SUCCESS"):  # nothing there, or a write that did not finish
        spark.createDataFrame([(source,)], "source string").coalesce(1).write.mode("overwrite").json(path)
        return
    owner = spark.read.schema("source string").json(path).first()["source"]
    if owner != source:
        raise ValueError(f"stream {name!r} of {root} loads {owner}; give {source} a name of its own")


def start_incremental_load(
    spark: SparkSession,
    source_dir: str,
    root: str,
    name: str = "telemetry",
    checkpoint: str | None = None,
    max_files_per_trigger: int = 1000,
    available_now: bool = True,
    spread_input: bool = False,
    counted: dict[str, dict[str, int]] | None = None,
    parts: bool = False,
) -> StreamingQuery:
    """``spread_input`` rebalances a batch's raw lines before the decode, for large files
    that cannot be split (gzip). ``checkpoint`` must name the same folder on every run.
    ``counted`` gets the counters of every batch written, by its load_id. ``parts`` writes a
    batch's page parts behind its facts (``sources/parts.py``)."""
    if checkpoint is None:
        checkpoint = f"{stream_folder(root, name)}/checkpoint"
        _own(spark, root, name, source_dir)
    mark = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:10]
    lines = (
        spark.readStream.format("text")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .option("recursiveFileLookup", "true")
        .load(source_dir)
    )

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        obs = Observation("load")
        raw = batch.hint("rebalance") if spread_input else batch
        counters = [c.alias(n) for n, c in D.count_columns().items()]
        load_id = f"{name}-{mark}-{batch_id}"
        write_facts(stored_rows(D.decode_with_lines(raw).observe(obs, *counters)), root, load_id=load_id)
        if parts:
            fill_parts(spark, root, load_id)
        counts = [(load_id, k, int(v)) for k, v in obs.get.items()]
        spark.createDataFrame(counts, "load_id string, counter string, n bigint").coalesce(1).write.mode(
            "overwrite").parquet(f"{stream_folder(root, name)}/counts/batch={mark}-{batch_id}")
        if counted is not None:
            counted[load_id] = {k: n for _, k, n in counts}

    writer = (
        lines.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .queryName(f"usagelens_{name}_{mark}")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def stream_counts(spark: SparkSession, root: str, name: str = "telemetry") -> DataFrame:
    """D17 for the stream: (load_id, counter, n) of every batch so far."""
    path = f"{stream_folder(root, name)}/counts"
    schema = "load_id string, counter string, n bigint"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def run_incremental_load(spark: SparkSession, source_dir: str, root: str, name: str = "telemetry", **kw) -> dict[str, int]:
    """Process every file present now; returns the counters of the batches of this run."""
    counted: dict[str, dict[str, int]] = {}
    q = start_incremental_load(spark, source_dir, root, name, available_now=True, counted=counted, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    names = {k: None for counts in counted.values() for k in counts}
    return {k: sum(counts.get(k, 0) for counts in counted.values()) for k in names}
