"""Employee directory: CSV in (S2), first row wins per email (S3), CSV out.

* Standard CSV: quotes are doubled inside quotes, a quoted field may hold commas and line
  breaks, a backslash is an ordinary character. Columns are taken by the header of each
  file, in any order; each field is stripped of surrounding whitespace; an empty field is
  the empty string, as Python's csv gives it.
* Within one load the first row of an email wins, in the stated order of the
  paths, then file name, then position in the file. The choice is a ``min_by``
  aggregate, so a repeated email is collapsed map-side before the shuffle, however
  many copies it has.
* Across loads the stored rows win (insert-or-ignore): only emails not yet
  stored are appended (``left_anti``).

Files are split like any text, also inside quoted fields: lines are read in blocks, and a prefix
sum over the blocks of a file of the lines with an odd number of quotes tells whether a block starts
inside a quoted field. A task then passes over its blocks line by line and joins the lines of
each record, holding one record at a time; only records that cross a block's edge are joined by a
shuffle. Headers are found in the same pass, so the number of jobs does not depend on
the number of files. A file with a quote inside an unquoted field, where counting quotes
says nothing, is read whole by one task as before.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from usagelens.functions.casts import strip_ws
from usagelens.schemas import EMPLOYEES
from usagelens.session import stage_table

FIELDS = [f.name for f in EMPLOYEES.fields]


# RFC 4180, as Python's csv reads and writes it.
STANDARD_CSV = {"header": True, "quote": '"', "escape": '"', "multiLine": True}


_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+)'
_WELL_FORMED = f"^{_FIELD}(?:,{_FIELD})*+$"
_FILE = ["path_no", "file"]


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Every line with its path number, file and the block it was read in, in the order read; and
    whether it has an odd number of quotes."""
    odd = (F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))) % 2
    frames = [spark.read.option("lineSep", "\n").text(path).select(
        F.lit(i).alias("path_no"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), "value", odd.alias("odd")) for i, path in enumerate(paths)]
    return reduce(DataFrame.unionByName, frames)


_PIECES = "path_no int, file string, at long, record string, pair long"


def _record_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's lines, in the order read -> records, with ``pair`` null, and the pieces of those that
    cross a block's edge, with the number that all pieces of one record share. ``at`` = 2 * block + line grows
    along a file: a block has no more lines than bytes, and one."""
    key, line, before, first, held, whole = None, 0, 0, 0, [], True
    out: list[tuple] = []

    def give() -> pa.RecordBatch:
        cols = list(zip(*out)) or [()] * 5
        types = [pa.int32(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                          names=["path_no", "file", "at", "record", "pair"])

    for batch in batches:
        for path_no, file, block, value, odd, base in zip(*[c.to_pylist() for c in batch.columns]):
            if (path_no, file, block) != key:
                if held:
                    out.append((*key[:2], 2 * key[2] + first, "\n".join(held), before // 2))
                key, line, before, first, held, whole = (path_no, file, block), 0, base, 0, [], base % 2 == 0
            if before % 2 == 0 and not odd:
                out.append((path_no, file, 2 * block + line, value, None))
            else:
                if not held:
                    first = line
                held.append(value)
                if odd and before % 2:
                    out.append((path_no, file, 2 * block + first, "\n".join(held), None if whole else before // 2))
                    held, whole = [], True
                before += odd
            line += 1
        yield give()
    if held:
        out.append((*key[:2], 2 * key[2] + first, "\n".join(held), before // 2))
    yield give()


def csv_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path_no, file, at, record): the records of all files, quoted line breaks inside,
    with the place of their first line in the file; blank ones are dropped."""
    lines = _lines(spark, paths)
    block = [*_FILE, "block"]
    earlier = W.partitionBy(*_FILE).orderBy("block").rowsBetween(W.unboundedPreceding, -1)  # a row a block
    bases = lines.groupBy(*block).agg(F.sum("odd").alias("n")).select(*block, F.sum("n").over(earlier).alias("base"))
    # A row for every block behind a quote: a join that moved the lines would lose their order.
    placed = lines.join(F.broadcast(bases.where("base > 0")), block, "left")
    pieces = stage_table(placed.select(*block, "value", "odd", F.coalesce("base", F.lit(0).cast("long")).alias("base"))
                         .mapInArrow(_record_batches, _PIECES), "employee-records")
    cut = F.array_sort(F.collect_list(F.struct("at", "record")))  # the pieces of one record: one a block
    joined = (pieces.where("pair IS NOT NULL").groupBy(*_FILE, "pair").agg(cut.alias("parts"))
              .select(*_FILE, F.col("parts")[0]["at"].alias("at"),
                      F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record")))
    whole = F.regexp_replace(F.col("record"), "^\\uFEFF|\\r$", "")
    records = pieces.where("pair IS NULL").select(*_FILE, "at", "record").unionByName(joined)
    return records.withColumn("record", whole).where(F.length("record") > 0)


def _fields(record: Column) -> Column:
    """The unquoted fields of a well-formed record."""
    raw = F.regexp_extract_all(record, F.lit(f"(?:^|,)({_FIELD})"), F.lit(1))
    return F.transform(raw, lambda f: F.when(f.startswith('"'), F.replace(
        F.substring(f, F.lit(2), F.length(f) - F.lit(2)), F.lit('""'), F.lit('"'))).otherwise(f))


def _read_whole(spark: SparkSession, file_no: int, file: str) -> DataFrame:
    """One file by one task, with Spark's own rules for quotes in unquoted fields."""
    raw = spark.read.options(**STANDARD_CSV).csv(unquote(file))
    _require(file, raw.columns)
    order = F.struct(F.lit(file_no).alias("file_no"), F.monotonically_increasing_id().alias("at"))
    return raw.select(*[F.coalesce(strip_ws(F.col(f"`{c}`")), F.lit("")).alias(c) for c in FIELDS], order.alias("_order"))


def _require(file: str, header: Sequence[str]) -> None:
    missing = [c for c in FIELDS if c not in header]
    if missing:
        raise ValueError(f"{file}: no column {missing}")


def read_employee_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Rows of one or more CSV files or folders (with header), stripped, with an order key
    ``_order`` = (number of the file by path and name, place in the file)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    records = csv_records(spark, paths)
    # By numbers and flags, which a hash aggregate holds: no sort of the records.
    firsts = records.groupBy(*_FILE).agg(F.min("at").alias("first"), F.max(~F.col("record").rlike(_WELL_FORMED)).alias("odd"))
    head = records.select(*_FILE, F.col("at").alias("first"), F.col("record").alias("header"))
    files = stage_table(head.join(F.broadcast(firsts), [*_FILE, "first"]).select(
        *_FILE, "first", "odd", F.row_number().over(W.orderBy(*_FILE)).alias("file_no"),  # a row a file
        F.when(~F.col("odd"), _fields(F.col("header"))).alias("names")), "employee-files")
    short = F.size(F.array_except(F.array(*[F.lit(c) for c in FIELDS]), "names")) > 0
    found = files.agg(F.count(F.lit(1)).alias("n"), F.max("odd").alias("odd"),
                      F.min(F.when(short, F.struct(*_FILE, "names"))).alias("short")).first()
    if not found["n"]:
        raise ValueError(f"no employee CSV with a header under {paths}")
    if found["short"]:
        _require(found["short"]["file"], found["short"]["names"])
    rows = records.join(files.where(~F.col("odd")), _FILE).where("at != first").withColumn("_f", _fields(F.col("record")))
    values = [F.coalesce(strip_ws(F.get("_f", F.array_position("names", c).cast("int") - 1)), F.lit("")).alias(c) for c in FIELDS]
    out = rows.select(*values, F.struct("file_no", "at").alias("_order"))
    whole = files.where("odd").orderBy("file_no").select("file_no", "file").collect() if found["odd"] else []  # files outside of the standard
    return reduce(DataFrame.unionByName, [_read_whole(spark, r["file_no"], r["file"]) for r in whole], out)


def first_per_email(rows: DataFrame) -> DataFrame:
    """S3 within a load: the first row (by ``_order``) of each email."""
    first = rows.groupBy("email").agg(
        F.min_by(F.struct(*[c for c in FIELDS if c != "email"]), F.col("_order")).alias("r")
    )
    return first.select("email", *[F.col(f"r.{c}").alias(c) for c in FIELDS if c != "email"])


def insert_or_ignore(stored: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """Rows of ``incoming`` (already one per email) whose email is not stored."""
    if stored is None:
        return incoming
    return incoming.join(stored.select("email"), "email", "left_anti").select(*FIELDS)


def load_employee_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """S2 + S3: the employee dimension of one load (one row per email)."""
    return first_per_email(read_employee_csv(spark, paths))


def write_employee_csv(employees: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Standard CSV with header; values keep their blanks, quotes are doubled."""
    (employees.select(*FIELDS).write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
