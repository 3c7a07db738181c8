"""Stored tables (S4-S6): Parquet under one root folder.

Layout::

    <root>/employees/<load_id>--part-*      the dimension (small files); ``_employees``: loads on their way in
    <root>/facts/table=<name>/event_date=<d>/load_id=<id>/part-*.parquet
    <root>/parts/                           sums of the API requests (``sources/parts.py``)
    <root>/_stream/<name>/                  what an incremental load remembers
    <root>/_compact/<id>/                   a merged day on its way in (``compact``, ``settle``)

All four fact tables come out of one decode pass and one write job: the wide
decoded row is written partitioned by ``table``, so each table is one folder.
A reader lists that folder only, and prunes to the days of a date filter.
Each load has its own ``load_id`` and is written with dynamic partition
overwrite, so a batch load adds rows (a second load of the same file doubles
them, as the reference does) while a replayed stream batch, which reuses its
``load_id``, replaces only its own output (exactly once).

Only a folder that does not exist reads as an empty table; every other error
(a corrupt or forbidden file, a lost store) is raised.

``declare_tables`` declares the five tables in the session's catalog if missing;
``query`` asks them in SQL with bound parameters.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.operators import decode as D
from usagelens.schemas import DECODED, EMPLOYEES, FACT_SCHEMAS, KIND_TABLE
from usagelens.sources.employees import first_per_email, insert_or_ignore, read_employee_csv
from usagelens.sources.telemetry import read_log_lines
from usagelens.tables import UsageTables

PARTITIONS = ["table", "event_date", "load_id"]
MALFORMED = "malformed"
QUARANTINE = "_quarantine"
DECIDED = "decided.json"
LOAD_END = "--"
STORED_FACTS = T.StructType(
    list(DECODED.fields)
    + [T.StructField("line", T.StringType()),
       T.StructField("table", T.StringType()), T.StructField("event_date", T.DateType()),
       T.StructField("load_id", T.StringType())]
)


def facts_path(root: str) -> str:
    return f"{root.rstrip('/')}/facts"


def employees_path(root: str) -> str:
    return f"{root.rstrip('/')}/employees"


def _table_of_kind():
    return F.element_at(F.create_map(*[F.lit(x) for kv in KIND_TABLE.items() for x in kv]), F.col("kind"))


def write_facts(decoded: DataFrame, root: str, load_id: str, files_per_day: int | None = None,
                max_records_per_file: int | None = None, layout: str = "rebalance") -> None:
    """Append routed rows (skipped events are not stored) under ``load_id``.

    Rows of kind ``malformed`` (with a ``line`` column) go to the quarantine folder
    ``table=_quarantine``. How rows reach the files (``layout``):

    * ``"rebalance"`` (default): one shuffle on (table, day) with Spark's REBALANCE
      hint; AQE cuts a busy day into several tasks of about
      ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` and merges quiet days,
      so files have a steady size whatever the input's file layout or skew.
    * ``"narrow"``: no shuffle; each task writes one file per table and day it
      holds. Only for large, time-ordered input files, where a task spans few days.

    ``files_per_day`` (overrides ``layout``) shuffles on (table, day, salt) with a
    salt in ``[0, files_per_day)`` instead; ``max_records_per_file`` caps file size."""
    if layout not in ("rebalance", "narrow"):
        raise ValueError("layout must be 'rebalance' or 'narrow'")
    line = F.col("line") if "line" in decoded.columns else F.lit(None).cast("string")
    table = F.when(F.col("kind") == MALFORMED, F.lit(QUARANTINE)).otherwise(_table_of_kind())
    rows = decoded.where(F.col("kind") != D.SKIPPED).select(
        *[F.col(f.name) for f in DECODED.fields],
        line.alias("line"),
        table.alias("table"),
        F.to_date("timestamp").alias("event_date"),
        F.lit(load_id).alias("load_id"),
    )
    if files_per_day:
        salt = F.pmod(F.xxhash64("event_id", "timestamp", "line"), F.lit(files_per_day))
        rows = rows.repartition("table", "event_date", salt)
    elif layout == "rebalance":
        rows = rows.hint("rebalance", "table", "event_date")
    drop_parts(decoded.sparkSession, root, load_id)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.partitionBy(*PARTITIONS).parquet(facts_path(root))


def _folder(spark: SparkSession, path: str):
    """(Hadoop file system, path)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asks the file system; any trouble in asking is raised, not taken as a no."""
    fs, p = _folder(spark, path)
    return bool(fs.exists(p))


def stored_days(spark: SparkSession, root: str, table: str) -> list[str]:
    """The days a table holds, from its folder names: one listing, no file opened."""
    settle(spark, root)
    path = _table_path(root, table)
    if not path_exists(spark, path):
        return []
    fs, p = _folder(spark, path)
    names = [f.getPath().getName() for f in fs.listStatus(p)]
    days = [n.partition("=")[2] for n in names if n.startswith("event_date=")]
    return sorted(d for d in days if d[:1].isdigit())


def _employee_files(spark: SparkSession, root: str) -> list[str]:
    """Names of the files of the dimension; one listing."""
    p = employees_path(root)
    if not path_exists(spark, p):
        return []
    fs, folder = _folder(spark, p)
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return [n for n in names if n[0] not in "_."]


def read_employees(spark: SparkSession, root: str) -> DataFrame | None:
    """The stored dimension, one row per email. Where several loads have files (each file is named
    after its load), two of them may have run side by side and both brought an email:
    then the row of the earlier load_id is the email's, for every reader."""
    p = employees_path(root)
    if not path_exists(spark, p):
        return None
    loads = {n.partition(LOAD_END)[0] if LOAD_END in n else "" for n in _employee_files(spark, root)}
    if len(loads) < 2:
        return spark.read.schema(EMPLOYEES).parquet(p)
    rows = spark.read.schema(T.StructType([*EMPLOYEES.fields, T.StructField("load_id", T.StringType())])).parquet(p)
    others = [c for c in EMPLOYEES.names if c != "email"]
    first = rows.groupBy("email").agg(F.min_by(F.struct(*others), F.coalesce("load_id", F.lit(""))).alias("r"))
    return first.select(*[F.col("email") if c == "email" else F.col(f"r.{c}").alias(c) for c in EMPLOYEES.names])


def stage_employees(spark: SparkSession, root: str, csv_paths: str | Sequence[str]) -> tuple[str, int]:
    """S2 + S3 + J4: the emails of the CSV files that are not stored yet, written beside the
    dimension. Returns the load_id, which starts with the time, and the number of rows."""
    load_id = f"{time.time_ns() // 1_000_000:015d}-{uuid.uuid4().hex[:8]}"
    incoming = first_per_email(read_employee_csv(spark, csv_paths))
    place = f"{root.rstrip('/')}/_employees/{load_id}"
    new = insert_or_ignore(read_employees(spark, root), incoming)
    new.select(*EMPLOYEES.names, F.lit(load_id).alias("load_id")).write.parquet(place)
    return load_id, spark.read.schema(EMPLOYEES).parquet(place).count()


def publish_employees(spark: SparkSession, root: str, load_id: str) -> None:
    """Move a staged load's files into the dimension, file by file under names of their own, so loads
    side by side do not touch each other. After a stop midway the load can be published, or
    appended, again."""
    place = f"{root.rstrip('/')}/_employees/{load_id}"
    fs, p = _folder(spark, place)
    target = employees_path(root)
    fs.mkdirs(_folder(spark, target)[1])
    for f in fs.listStatus(p):
        name = f.getPath().getName()
        if name.startswith("part-") and not fs.rename(f.getPath(), _folder(spark, f"{target}/{load_id}{LOAD_END}{name}")[1]):
            raise RuntimeError(f"{f.getPath()} could not be moved to {target}")
    fs.delete(p, True)


def append_employees(spark: SparkSession, root: str, csv_paths: str | Sequence[str]) -> int:
    """S2 + S3 + J4: add the emails of the CSV files that are not stored yet. Returns how many
    rows were added; of an email that another load added at the same time, one row is
    read (``read_employees``). A table that ``declare_tables`` declares shows both."""
    load_id, n = stage_employees(spark, root, csv_paths)
    if n:
        publish_employees(spark, root, load_id)
    else:
        fs, place = _folder(spark, f"{root.rstrip('/')}/_employees/{load_id}")
        fs.delete(place, True)
    return n


@dataclass
class LoadReport:
    counts: dict[str, int]
    load_id: str


def load_telemetry(spark: SparkSession, root: str, paths: str | Sequence[str], load_id: str | None = None,
                   spread_input: bool | str = True, **write_options) -> LoadReport:
    """S1-S4 + D1-D17 in one job: read lines, decode, write the four tables and the
    quarantined lines, and count rows per table, skipped events and malformed lines
    on the way (``Observation``; no second pass). ``spread_input`` as in
    ``read_log_lines`` (``"always"`` for a large unsplittable file).

    ``posexplode_outer`` keeps one row for a malformed line (and for an envelope
    without events, which is then dropped), so lines and events share one pass."""
    load_id = load_id or f"batch-{uuid.uuid4().hex[:12]}"
    obs = Observation("load")
    decoded = D.decode_with_lines(read_log_lines(spark, paths, spread_input))
    counters = [c.alias(n) for n, c in D.count_columns().items()]
    write_facts(stored_rows(decoded.observe(obs, *counters)), root, load_id, **write_options)
    return LoadReport({k: int(v) for k, v in obs.get.items()}, load_id)


def stored_rows(decoded: DataFrame) -> DataFrame:
    """``decode_with_lines`` rows -> events and quarantined lines for ``write_facts``."""
    return decoded.where(F.col("pos").isNotNull() | ~F.col("envelope_ok")).select(
        F.when(F.col("envelope_ok"), F.col("kind")).otherwise(F.lit(MALFORMED)).alias("kind"),
        F.when(~F.col("envelope_ok"), F.col("line")).alias("line"),
        *[f.name for f in DECODED.fields],
    )


def _table_path(root: str, table: str) -> str:
    return f"{facts_path(root)}/table={table}"


def _read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """One table's folder, listed alone; empty of the declared schema if missing."""
    settle(spark, root)
    path = _table_path(root, table)
    schema = T.StructType([f for f in STORED_FACTS.fields if f.name != "table"])
    if path_exists(spark, path):
        return spark.read.schema(schema).option("basePath", path).parquet(path)
    return spark.createDataFrame([], schema)


def _load_folders(spark: SparkSession, path: str, load_id: str | None = None) -> list:
    """Hadoop paths of the (day, load) folders under ``path``, of one load or of all."""
    if not path_exists(spark, path):
        return []
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    load = "*" if load_id is None else names.escapePathName(load_id)
    fs, p = _folder(spark, f"{path}/event_date=*/load_id={load}")
    return [f.getPath() for f in fs.globStatus(p)]


def day_loads(spark: SparkSession, root: str, table: str, load_id: str | None = None) -> list[tuple[str, str]]:
    """The (day, load) folders of a table, or of one load; no file opened."""
    settle(spark, root)
    return named_pairs(_load_folders(spark, _table_path(root, table), load_id))


def named_pairs(folders: list) -> list[tuple[str, str]]:
    names = ((f.getParent().getName(), f.getName()) for f in folders)
    return sorted((d.partition("=")[2], i.partition("=")[2]) for d, i in names)


def parts_path(root: str) -> str:
    return f"{root.rstrip('/')}/parts"


def part_pairs(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """The (day, load) folders that have page parts."""
    return named_pairs(_load_folders(spark, parts_path(root)))


def drop_parts(spark: SparkSession, root: str, load_id: str) -> None:
    """Remove a load's page parts: its facts are about to be written (again)."""
    for folder in _load_folders(spark, parts_path(root), load_id):
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def facts_of(spark: SparkSession, root: str, table: str, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """The facts of some (day, load) folders of a table, as ``read_facts`` gives them."""
    path = _table_path(root, table)
    schema = T.StructType([f for f in STORED_FACTS.fields if f.name != "table"])
    cols = [f.name for f in FACT_SCHEMAS[table].fields]
    return (spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/event_date={d}/load_id={i}" for d, i in pairs])
            .select(*cols, "event_date", "load_id"))


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """The malformed lines of every load (``line``, ``load_id``)."""
    return _read_table(spark, root, QUARANTINE).select("line", "load_id")


def stored_counts(spark: SparkSession, root: str) -> DataFrame:
    """Rows stored per fact table (``fact_table``, ``rows``), over every load; one
    aggregate over the partitioned folders (partial counts per task)."""
    schema = T.StructType([T.StructField("fact_table", T.StringType()), T.StructField("rows", T.LongType())])
    path = facts_path(root)
    settle(spark, root)
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    facts = spark.read.schema(STORED_FACTS).option("basePath", path).parquet(path).where(F.col("table") != QUARANTINE)
    return facts.groupBy(F.col("table").alias("fact_table")).agg(F.count(F.lit(1)).alias("rows"))


def read_facts(spark: SparkSession, root: str, table: str) -> DataFrame:
    """S5 + S6: one fact table with its ``event_date`` (for pruning) and ``load_id``;
    an empty table of the declared schema when nothing was loaded yet."""
    cols = [f.name for f in FACT_SCHEMAS[table].fields]
    return _read_table(spark, root, table).select(*cols, "event_date", "load_id")


def stored_tables(spark: SparkSession, root: str) -> UsageTables:
    emp = read_employees(spark, root)
    if emp is None:
        emp = spark.createDataFrame([], EMPLOYEES)
    facts = {t: read_facts(spark, root, t) for t in FACT_SCHEMAS}
    days = stored_days(spark, root, "api_requests")
    return UsageTables(employees=emp, days=(days[0], days[-1]) if days else None, **facts)


def declare_tables(spark: SparkSession, root: str, prefix: str = "usage_") -> list[str]:
    """``CREATE TABLE IF NOT EXISTS`` for the five tables over the store's folders, so
    that other sessions of a shared catalog see them, and their folders found so far taken
    in (declare again after a load); returns their names."""
    names = []
    for table, schema in {"employees": EMPLOYEES, **FACT_SCHEMAS}.items():
        fact = table in FACT_SCHEMAS
        columns = [*schema.fields]
        parts = ""
        if fact:
            columns += [T.StructField("event_date", T.DateType()), T.StructField("load_id", T.StringType())]
            parts = " PARTITIONED BY (event_date, load_id)"
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
        path = _table_path(root, table) if fact else employees_path(root)
        fs, p = _folder(spark, path)
        fs.mkdirs(p)
        where = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{prefix}{table}` ({ddl}) USING parquet{parts} LOCATION '{where}'")
        if fact:
            spark.sql(f"ALTER TABLE `{prefix}{table}` RECOVER PARTITIONS")
        names.append(f"{prefix}{table}")
    return names


def query(spark: SparkSession, root: str, text: str, args: dict | list | None = None) -> DataFrame:
    """SQL over the stored tables, with values passed as bound parameters (``:name`` or
    ``?``), never spliced into the text. A table is named ``{employees}``,
    ``{api_requests}``, ``{user_prompts}``, ``{tool_events}`` or ``{api_errors}``."""
    t = stored_tables(spark, root)
    frames = {n: getattr(t, n) for n in ("employees", *FACT_SCHEMAS) if "{" + n + "}" in text}
    return spark.sql(text, args=args, **frames)


def _decision(root: str) -> str:
    return f"{root.rstrip('/')}/_compact"


def settle(spark: SparkSession, root: str) -> int:
    """Finish what ``compact`` decided and did not live to do: remove the merged folders that
    are left, move the merged copy in. Any reader or writer of the store may do it, again and at the same
    time; returns the number of decisions found."""
    if not path_exists(spark, _decision(root)):
        return 0
    fs, p = _folder(spark, _decision(root))
    done = 0
    for d in fs.listStatus(p):
        note = _folder(spark, f"{d.getPath().toString()}/{DECIDED}")[1]
        if not fs.exists(note):
            continue  # merged rows nobody has decided to use
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(fs.open(note), "UTF-8")
        plan = json.loads(text)
        folder = f"{root.rstrip('/')}/{plan['folder']}"
        for name in plan["old"]:
            fs.delete(_folder(spark, f"{folder}/{name}")[1], True)
        merged, target = (_folder(spark, f"{x}/{plan['new']}")[1] for x in (d.getPath().toString(), folder))
        if fs.exists(merged) and not fs.exists(target):
            if not fs.rename(merged, target) and not fs.exists(target):
                raise RuntimeError(f"{merged} holds the merged rows of {folder} and could not be moved there")
        fs.delete(d.getPath(), True)
        done += 1
    return done


def compact(spark: SparkSession, root: str, table: str, day: str) -> int:
    """Merge the load folders of one closed day of a table into one; returns how many there
    were. For days that no running load or replayed stream batch writes to.

    The merged rows are written and counted outside the table; nothing has changed until a
    small file next to them, put there by one rename, says which folders they replace. From then
    on the merge is decided, and ``settle`` carries it out: here, or, after a crash, before the next
    read. So every read finds each row once, wherever the job stopped."""
    settle(spark, root)
    name = f"event_date={day}"
    folder = f"{_table_path(root, table)}/{name}"
    if not path_exists(spark, folder):
        return 0
    fs, p = _folder(spark, folder)
    old = sorted(f.getPath().getName() for f in fs.listStatus(p) if f.getPath().getName().startswith("load_id="))
    if len(old) < 2:
        return len(old)
    schema = T.StructType([f for f in STORED_FACTS.fields if f.name not in PARTITIONS])
    rows = spark.read.schema(schema).parquet(*[f"{folder}/{o}" for o in old])
    key = f"compact-{uuid.uuid4().hex[:12]}"
    place, new = f"{_decision(root)}/{key}", f"load_id={key}"
    rows.hint("rebalance").write.parquet(f"{place}/{new}")
    if spark.read.schema(schema).parquet(f"{place}/{new}").count() != rows.count():
        raise RuntimeError(f"{folder} changed while it was merged; nothing was replaced")
    text = json.dumps({"folder": f"facts/table={table}/{name}", "old": old, "new": new})
    draft, note = (_folder(spark, f"{place}/{x}")[1] for x in (f"_{DECIDED}", DECIDED))
    out = fs.create(draft)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(draft, note):
        raise RuntimeError(f"{note} could not be written; nothing was replaced")
    settle(spark, root)
    return len(old)
