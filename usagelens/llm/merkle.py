"""Merkle manifest of a table: a tree per source, one tree over their roots, proofs per row.

A leaf is the SHA-256 of a row's fields. Per source, leaves stand in the order of doc_id;
16 consecutive nodes (the last run may have fewer, even one) become their parent, level by
level, until one node is left, the subroot. The subroots, in the order of their sources,
are the leaves of a tree built in the same way, whose last node is the root.

*Places.* Leaves are hashed where the texts are read and staged; from then on only digests
travel. Range partitions of (source, doc_id, leaf, row number) give every leaf its place
among its source's: rows before it in its partition plus the source's rows in earlier ones.
The row number, fixed by the staged file, is part of the order, so a source with a third of
all rows, or a third of rows that are copies of one, is cut like any other.

*Levels.* A level's nodes are windowed by (source, run of 16): columns of lag and lead 1 to 15,
masked by the node's slot and the run's length, are its siblings; the run's first child
hashes the parent. A level is a sixteenth of the one below, and is staged for the way down.

*Proofs.* On the way down a node takes its parent's path by a join on (source, run), the very
keys of its window, so each level's nodes move once. The whole path of a leaf is its
siblings level by level up to the root, as (left, right) pairs of raw digests.

Cases: a null field is ``-`` in the leaf; rows of null doc_id come first in their source; rows
equal in doc_id stand in the order of their leaves, equal rows next to each other in any order;
rows of null source are a source of their own, the first; a source of one row has that leaf as its
subroot; with one source the subroot is the root; a lone row's proof is the hash of nothing;
an empty table gives no rows; columns other than those named are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from usagelens.llm.common import stage, width

FAN_OUT = 16
ROWS_PER_TASK = 500_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_NOTHING = b""


def leaf_digest(fields: dict[str, Column]) -> Column:
    """Raw SHA-256 of the fields in order: ``-`` if null, else byte count, ``:``, value."""
    def one(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[one(c) for c in fields.values()]), 256))


def _hash(digests: Column) -> Column:
    """Raw SHA-256 of raw digests written as lowercase hex text."""
    return F.unhex(F.sha2(F.lower(F.hex(digests)), 256))


def _text(digest: str | Column) -> Column:
    return F.lower(F.hex(digest))


def _placed(rows: DataFrame, order: list[Column], name: str, rows_per_task: int) -> DataFrame:
    """``rows`` with ``pos``, the place in the row's ``grp`` by ``order`` (a total order), and
    ``n``, the group's rows."""
    tasks = width(rows.sparkSession, rows.count(), rows_per_task)
    ranged = stage(rows.repartitionByRange(tasks, "grp", *order).withColumn("part", F.spark_partition_id()), f"{name}-ranges")
    totals = ranged.groupBy("part", "grp").agg(F.count(F.lit(1)).alias("c"))  # partitions plus groups, at most
    earlier = W.partitionBy("grp").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = totals.select("part", "grp", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("base"),
                          F.sum("c").over(W.partitionBy("grp")).alias("n"))
    inside = W.partitionBy("part", "grp").orderBy(*order)
    placed = (ranged.withColumn("at", F.row_number().over(inside)).join(bases, ["part", "grp"])
              .withColumn("pos", F.col("base") + F.col("at") - 1).drop("part", "at", "base"))
    return stage(placed, f"{name}-places")


def _with_siblings(nodes: DataFrame) -> DataFrame:
    """Nodes with ``run`` and the raw digests of the run's others: ``left`` and ``right``."""
    fan, slot = F.lit(FAN_OUT).cast("long"), F.col("pos") % FAN_OUT
    numbered = nodes.withColumn("run", F.floor(F.col("pos") / fan).cast("long"))
    length = F.least(fan, F.col("n") - F.col("run") * fan)
    run = W.partitionBy("grp", "run").orderBy("pos")
    none = F.lit(_NOTHING)
    lags = [F.when(slot >= k, F.lag("digest", k).over(run)).otherwise(none) for k in range(FAN_OUT - 1, 0, -1)]
    leads = [F.when(slot + k < length, F.lead("digest", k).over(run)).otherwise(none) for k in range(1, FAN_OUT)]
    return numbered.withColumns({"left": F.concat(*lags), "right": F.concat(*leads)})


def _levels(leaves: DataFrame, name: str) -> list[DataFrame]:
    """(grp, pos, n, digest) per level, from ``leaves`` (which may have more columns) upwards."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels = [leaves]
    while most > 1:
        first = _with_siblings(levels[-1].where(F.col("n") > 1).select("grp", "pos", "n", "digest")).where(F.col("pos") % FAN_OUT == 0)
        parents = first.select("grp", F.col("run").alias("pos"), F.ceil(F.col("n") / FAN_OUT).cast("long").alias("n"),
                               _hash(F.concat("digest", "right")).alias("digest"))
        levels.append(stage(parents, f"{name}-level{len(levels)}"))
        most = -(-most // FAN_OUT)
    return levels


def _last_nodes(levels: list[DataFrame]) -> DataFrame:
    """(grp, digest) of the node that remains of each group."""
    return reduce(DataFrame.unionByName, [t.where(F.col("n") == 1).select("grp", "digest") for t in levels])


def _paths(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The lowest level's rows with ``path``, and the columns of ``tops``: (grp, path, more),
    the path of each group's last node."""
    more = [c for c in tops.columns if c not in ("grp", "path")]
    down = None
    for level in reversed(levels):
        last = level.where(F.col("n") == 1).join(tops, "grp")  # a row a group
        rows = last.select(*level.columns, "path", *more)
        if down is not None:
            above = down.select("grp", F.col("pos").alias("run"), F.col("path").alias("above"), *more)
            pair = F.array(F.struct("left", "right"))
            nodes = _with_siblings(level.where(F.col("n") > 1)).join(above, ["grp", "run"])
            rows = rows.unionByName(nodes.select(*level.columns, F.concat(pair, "above").alias("path"), *more))
        down = rows
    return down


def manifest(docs: DataFrame, carry: dict[str, Column] | None = None, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """doc_id, source, leaf, subroot, root (raw digests), path (array of (left, right) raw
    digests from leaf to root) and the ``carry`` columns (expressions over FIELDS); one row per
    input row."""
    carry = carry or {}
    fields = {c: F.col(c) for c in FIELDS}
    rows = docs.select(*FIELDS).select(
        F.col("doc_id").cast("long").alias("doc_id"), "source",
        F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), F.col("source"))).alias("grp"),
        leaf_digest(fields).alias("digest"), F.monotonically_increasing_id().alias("row_no"),
        *[c.alias(name) for name, c in carry.items()])
    order = [F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("row_no")]
    leaves = _placed(stage(rows, "merkle-leaves"), order, "merkle", rows_per_task).drop("row_no")
    levels = _levels(leaves, "merkle")

    sources = stage(_last_nodes(levels).select(F.lit("").alias("grp"), F.col("grp").alias("of"), "digest"), "merkle-subroots")
    top = _levels(_placed(sources, [F.col("of")], "merkle-top", rows_per_task), "merkle-top")
    root = _last_nodes(top).select("grp", F.col("digest").alias("root"),  # one row
                                   F.array().cast("array<struct<left:binary,right:binary>>").alias("path"))
    tops = stage(_paths(top, root).select(F.col("of").alias("grp"), F.col("digest").alias("subroot"), "path", "root"), "merkle-tops")
    return _paths(levels, tops).select("doc_id", "source", F.col("digest").alias("leaf"), "subroot", "root", "path", *carry)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a raw leaf digest gives with the siblings of ``path``."""
    return F.aggregate(path, leaf, lambda node, s: _hash(F.concat(s["left"], node, s["right"])))


def proof_digest(path: Column) -> Column:
    """Raw SHA-256 of all siblings of a path, level by level, left to right."""
    return _hash(F.aggregate(path, F.lit(_NOTHING), lambda seen, s: F.concat(seen, s["left"], s["right"])))


def verified_manifest(docs: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The manifest's digests as text, and each row checked against the root after tampering: where
    5 divides crc32 of the decimal doc_id, the text's A-Z are lower-cased (nulls stay)."""
    fields = {c: F.col(c) for c in FIELDS}
    small = F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 5 == 0
    claimed = F.when(hit, leaf_digest({**fields, "text": small}))  # null: the row is untouched
    found = manifest(docs, {"claimed": claimed}, rows_per_task)
    folded = fold(F.coalesce("claimed", "leaf"), F.col("path"))
    return found.select("doc_id", _text("leaf").alias("leaf"), _text("subroot").alias("subroot"), _text("root").alias("root"),
                        _text(proof_digest(F.col("path"))).alias("proof_sha256"), _text(folded).alias("folded_root")
                        ).withColumn("verified", F.col("folded_root") == F.col("root"))
