"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Targets. Sources are ordered by code point, null last, and weigh 5, 2, 1 in turn. They
share SHARE times all words; a target stops at CAP times its source's words and the
excess goes to the others by weight. That is a water level: with sources ordered by cap
per weight, those below the level are at their cap and the rest get level * weight.

Blocks. A source's documents are put in a random order (a hash of id and size) and laid
out on an axis of words, again and again; the mix takes the first ``target`` words of it,
so whole rounds first, then a random part. The axis is cut into blocks of BLOCK words; a
document copy belongs to the block in which it starts. A source's quota is its number of
blocks, exactly.

Tree. The quotas are split among SHARDS output shards: a node hands half of its block
places to its left child by one multivariate hypergeometric draw over the sources, the
rest goes right, down to single shards. Every shard holds a random mixture and every
block is used once: a source's block numbers, those of later rounds too, are permuted by a
keyed permutation (``permuted``), and the shards draw disjoint runs of the permuted order,
each as many as the tree gave it. Inside a shard copies are ordered by a hash of document
and round (local shuffle). ``mixed_documents`` leaves its rows in that order, shard by shard.

A document's place on the axis comes from prefix sums in two levels: hash buckets of
about KEYS_PER_BUCKET keys, then within the bucket; so no source, however large, is
sorted in one task. Rows equal in (doc_id, source, size) are counted first and share a key;
they are unfolded in chunks that are dealt out.

Cases: a null or wordless text has size 0 and nothing of it is taken; a null source is a
source, the last; only the last document of a source's run is cut short; repeated rows
are separate documents; with no words at all targets are 0; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from usagelens.llm.common import partitions_for, ship, stage, unfold

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
SHARDS = 16
BLOCK = 16384
KEYS_PER_BUCKET = 4096
SEED = 20260101
ROUNDS = 32


def targets(sources: DataFrame) -> DataFrame:
    """(source, source_size, ...) -> with ``no`` (order) and ``target``; one row a source."""
    everywhere = W.orderBy("no").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), ((F.col("no") - 1) % len(WEIGHTS) + 1).cast("int"))
    s = (sources.withColumn("no", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
         .withColumn("weight", weight).withColumn("cap", CAP * F.col("source_size"))
         .withColumn("goal", SHARE * F.sum("source_size").over(everywhere)))
    by_level = W.orderBy(F.col("cap") / F.col("weight"), "no")
    before, after = by_level.rowsBetween(W.unboundedPreceding, -1), by_level.rowsBetween(W.currentRow, W.unboundedFollowing)
    level = (F.col("goal") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after)
    # The level if just the sources before this one are at their cap. It rises along the
    # order until a source stays below its cap, and falls from there: the highest holds.
    s = s.withColumn("level", level).withColumn("level", F.max("level").over(everywhere))
    return s.withColumn("target", F.least(F.col("cap").cast("double"),
                                          F.coalesce(F.col("level") * F.col("weight"), F.col("cap").cast("double"))))


def splitting_tree(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """(shards, sources): how many blocks of each source every shard gets."""
    rng = np.random.default_rng(seed)
    out = np.zeros((shards, len(quotas)), np.int64)

    def split(first: int, last: int, have: np.ndarray) -> None:
        if last - first == 1:
            out[first] = have
            return
        middle = (first + last) // 2
        places = int(have.sum()) * (middle - first) // (last - first)
        left = _draw(rng, have, places)
        split(first, middle, left)
        split(middle, last, have - left)

    split(0, shards, quotas.astype(np.int64))
    return out


def _draw(rng: np.random.Generator, have: np.ndarray, n: int) -> np.ndarray:
    """One multivariate hypergeometric draw, source by source."""
    out, rest = np.zeros_like(have), int(have.sum())
    for i, good in enumerate(have.tolist()):
        rest -= good
        got = _hypergeometric(rng, good, rest, n)
        out[i] = got
        n -= got
    return out


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """numpy's draw takes up to 10^9 blocks; above, the same law in halves of the sample."""
    if n == 0 or good == 0:
        return 0
    if bad == 0:
        return n
    if good + bad < 10 ** 9:
        return int(rng.hypergeometric(good, bad, n))
    if n == 1:
        return int(rng.random() * (good + bad) < good)
    first = _hypergeometric(rng, good, bad, n // 2)
    return first + _hypergeometric(rng, good - first, bad - (n // 2 - first), n - n // 2)


def permuted(number: Column, n: Column, key: Column, seed: int = SEED) -> Column:
    """``number`` (0 to n - 1) under a permutation of those numbers, one for every ``key``.

    A swap-or-not shuffle: a round pairs x with (k - x) mod n, where k is the round's own, and a
    hash of the larger one says whether the pair changes places. Each round is its own
    inverse, so the whole is a permutation for any n, found without a table or a sort."""
    def swap(x: Column, turn: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(F.lit(seed), key, turn), n) - x, n)
        go = F.xxhash64(F.lit(seed), turn, key, F.greatest(x, other)).bitwiseAND(F.lit(1).cast("long")) == 1
        return F.when(go, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), number.cast("long"), swap)


def _ends_up_to(ends: str, at: Column) -> Column:
    """How many of ``ends`` are at most ``at``, which is computed once."""
    return F.aggregate(ends, F.struct(at.alias("at"), F.lit(0).alias("n")),
                       lambda s, e: F.struct(s["at"].alias("at"), (s["n"] + (e <= s["at"]).cast("int")).alias("n")),
                       lambda s: s["n"])


def shard_bounds(plan: DataFrame, shards: int, block: int, seed: int) -> DataFrame:
    """Adds ``ends``: per shard the first place behind its run of the source's permuted
    blocks. One row a source."""
    ship(plan.sparkSession)

    def draw(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("no")
        got = splitting_tree((-(-rows["take"] // block)).to_numpy(), shards, seed)
        return pd.DataFrame({"no": rows["no"], "ends": list(np.cumsum(got, axis=0).T)})

    ends = plan.select("no", "take", F.lit("all").alias("g")).groupBy("g").applyInPandas(draw, "no int, ends array<long>")
    return plan.join(ends, "no")


def word_count(text: Column) -> Column:
    """Runs of bytes other than white space: places where a run begins."""
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def mix(docs: DataFrame, shards: int = SHARDS, block: int = BLOCK, seed: int = SEED, row: str | None = None) -> DataFrame:
    """doc_id, size, source, source_size, target, taken and ``draws``, one row per
    document: of every copy its shard, block, place (order by it inside the shard) and
    words. ``row`` names a column that numbers the rows, to be returned as ``row``."""
    number = F.col(row).cast("long") if row else F.lit(0).cast("long")
    keys = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                             word_count(F.col("text")).alias("size"), number.alias("row"))
                 .groupBy("doc_id", "source", "size", "row").agg(F.count(F.lit(1)).alias("copies")), "mix-keys")
    per_source = keys.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"),
                                            F.count(F.lit(1)).alias("n_keys"))
    plan = targets(per_source).withColumn("take", F.round("target").cast("long"))
    plan = stage(shard_bounds(plan, shards, block, seed), "mix-plan").select(
        "no", F.col("source").alias("of"), "source_size", "target", "take", "ends",
        F.ceil(F.col("n_keys") / KEYS_PER_BUCKET).alias("n_buckets"))

    h = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(seed), "row", "size")).otherwise(
        F.xxhash64(F.lit(seed), "doc_id", "size"))
    dealt = (keys.join(plan.select("no", "of", "n_buckets"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
             .withColumn("h", h).withColumn("bucket", F.pmod(F.shiftrightunsigned("h", 20), F.col("n_buckets"))))
    sums = dealt.groupBy("no", "bucket").agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
    earlier = W.partitionBy("no").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)  # a row a bucket
    bases = sums.select("no", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"))
    inside = W.partitionBy("no", "bucket").orderBy("h", "doc_id", "size", "row").rowsBetween(W.unboundedPreceding, -1)
    laid = (dealt.withColumn("pre", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(inside), F.lit(0)))
            .join(bases, ["no", "bucket"]))
    # Numbered rows have one copy each.
    laid = laid.withColumn("copy", F.lit(0).cast("long")) if row else unfold(laid, "no", "doc_id", "size", "row")
    laid = (laid.withColumn("start", F.col("base") + F.col("pre") + F.col("copy") * F.col("size"))
            .join(plan.drop("of", "n_buckets"), "no"))

    def drawn(turn: int) -> Column:
        at = F.col("start") + F.lit(turn) * F.col("source_size")
        words = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("take") - at))
        number = F.floor(at / F.lit(block))
        drawn_as = permuted(number, F.greatest(F.element_at("ends", -1), F.lit(1).cast("long")), F.col("no"), seed)
        shard = F.when(words > 0, _ends_up_to("ends", drawn_as))
        return F.struct(F.lit(turn).alias("turn"), shard.alias("shard"), number.alias("block"),
                        F.xxhash64(F.lit(seed), F.lit(turn), "doc_id", "size", "row", "copy").alias("place"), words.alias("words"))

    draws = F.filter(F.array(*[drawn(t) for t in range(CAP)]), lambda d: d["words"] > 0)
    return laid.withColumn("draws", draws).select(
        "doc_id", "size", "source", "source_size", "target",
        F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d["words"]).alias("taken"), "draws", *(["row"] if row else []))


def mixed_shards(docs: DataFrame, **options) -> DataFrame:
    """One row per copy in the mix: shard, place, doc_id, source, words (the document's
    first ``words`` words)."""
    return (mix(docs, **options).select("doc_id", "source", F.explode("draws").alias("d"))
            .select("d.shard", "d.place", "d.block", "doc_id", "source", "d.words"))


def mixed_documents(docs: DataFrame, shards: int = SHARDS, places: bool = False, **options) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: a row per copy, shard by shard and
    in a shard by place (a hash, so a shard is cut into equal slices of places, one a task;
    ``spark.sql.shuffle.partitions`` says how many in all). The copy that a target cuts
    keeps its first words, joined by single blanks, and its n_chars (if there) is its new
    length. ``places`` adds ``mix_shard`` and ``mix_place``, in place of columns so named."""
    row = "__mix_row"
    rows = stage(docs.withColumn(row, F.monotonically_increasing_id()), "mix-rows")
    draws = (mix(rows, row=row, shards=shards, **options)
             .select(F.col("row").alias(row), F.col("size").alias("__mix_size"), F.explode("draws").alias("__mix")))
    cut = F.col("__mix.words") < F.col("__mix_size")
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    short = F.concat_ws(" ", F.slice(words, 1, F.col("__mix.words").cast("int")))
    slices = -(-partitions_for(docs.sparkSession) // shards)
    # Places are spread evenly over all longs: their 32 high bits, from 0, name the slice.
    high = F.shiftright("__mix.place", 32) + F.lit(1 << 31)
    task = F.col("__mix.shard") * slices + F.shiftright(high * F.lit(slices).cast("long"), 32).cast("int")
    out = (rows.join(draws, row).repartitionById(shards * slices, task)
           .sortWithinPartitions("__mix.shard", "__mix.place", row, "__mix.turn")
           .withColumn("text", F.when(cut, short).otherwise(F.col("text"))))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(cut, F.char_length("text")).otherwise(F.col("n_chars")).cast(
            docs.schema["n_chars"].dataType))
    where = [F.col("__mix.shard").alias("mix_shard"), F.col("__mix.place").alias("mix_place")] if places else []
    named = ("mix_shard", "mix_place") if places else ()
    return out.select(*[c for c in docs.columns if c not in named], *where)


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """The mix as files, a folder ``mix_shard=<n>`` for each shard, its files in order of place."""
    mixed_documents(docs, places=True, **options).drop("mix_place").write.partitionBy("mix_shard").parquet(path)
