"""Near-duplicate documents with HyperMinHash sketches.

A document's set: its distinct runs of ``words`` neighbouring words (A-Z lower-cased,
words are runs of bytes other than 0x20 and 0x09-0x0D), each run a 64-bit hash. Two
documents are linked when 100 * |both| >= percent * |either|; components of linked
documents are groups.

1. *Sketch* (one pass over the texts). A hash falls into one of REGISTERS buckets; a
   register keeps, of its bucket's least value, the number of leading zeros (6 bits) and
   the next 10 bits. An empty register borrows from the filled one that comes first in
   a fixed random order of its own, so short documents fill all registers, each run
   about as many. Documents with equal sets become one node (equality by a 128-bit
   digest of the whole set).
2. *Buckets.* ROWS registers make a band; nodes that agree on a band share a bucket. Two
   nodes at similarity 0.8 share none of 40 with probability 5e-6. Sets of at most EXACT
   runs say too little by registers: those are bucketed by each of their first
   n - ceil(n * percent / 100) + 1 runs, the rarest among such sets first, of which two
   linked ones share one for certain. Sets that can only be linked with such have no
   bands.
3. *Star.* In a bucket every node is compared with the smallest: Jaccard estimate from
   equal registers, corrected for registers that agree by chance; pairs that come
   within five standard deviations of the limit, and all of two sets of at most EXACT
   runs, are confirmed on the full sets. This takes one row per member and joins whole
   groups of copies without pairs.
4. *Rest.* Where members of a bucket other than its smallest still lie in different
   components, the bucket is cut into tiles of at most about TILE members a side, and a
   tile compares its members across components in memory: estimate, then full sets.
   Only links leave it. So every pair that shares a bucket is decided, whatever the
   size of the bucket, and no list of pairs is ever written. A bucket of more than two
   blocks has a row for each member and block. Texts of one template fill such buckets without
   being linked, so the members of crowded buckets are first dealt out anew, by the rarest of
   their runs as the short sets are (by classes of runs counted among these members): linked ones
   share one for certain, and runs that no other component shares leave nothing to compare. The
   new buckets take the place of the crowded ones wherever that makes fewer rows.
5. *Components* of all links by least-neighbour labels with pointer jumping.

Full sets (48 bits of each hash) are computed again from the texts for the nodes that
need them, chosen by a bitmap of fixed size. Everything between passes is staged in the
shared checkpoint folder.

Cases: null, empty or wordless text: set size 0, linked with nothing, its own group and
kept; fewer words than ``words``: the whole sequence is one run; repeated rows are
documents with equal sets; a null doc_id counts only where its group has no other
(component_id is then null); an empty table gives an empty result; other columns are
passed through by ``deduplicate`` and ignored otherwise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.llm.common import partitions_for, ship, stage, text_or_empty

WORDS = 5
PERCENT = 80
REGISTERS = 240
ROWS = 6
MANTISSA = 10
TILE = 512
BITMAP_BITS = 1 << 26
ESTIMATE_MARGIN = 5.0
EXACT = 32
RUN_CLASS_BITS = 16
WORD_CACHE = 150_000

_U = np.uint64
# Expected share of registers of two unrelated sets that agree by chance, times 2^mantissa bits.
_CHANCE = 0.169919487159739


def _ranks() -> np.ndarray:
    """Of every register, all registers' ranks in the order in which it looks when empty."""
    rng = np.random.default_rng(20260101)
    return np.array([rng.permutation(REGISTERS) for _ in range(REGISTERS)], np.uint8)


RANKS = _ranks()


class WordHashes(dict):
    """Word -> 8 bytes of hash; keeps the first WORD_CACHE short words. One per Python
    worker serves every operator (``HASHES``)."""

    def __missing__(self, word: bytes) -> bytes:
        got = xxhash.xxh64_intdigest(word, 7).to_bytes(8, "little")
        if len(word) <= 64 and len(self) < WORD_CACHE:
            self[word] = got
        return got


HASHES = WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct hashes of the document's runs."""
    found = text.lower().split()  # bytes: ASCII case and white space only
    if not found:
        return np.zeros(0, np.uint64)
    h = np.frombuffer(b"".join(map(HASHES.__getitem__, found)), "<u8")
    if len(h) < words:
        return np.array([xxhash.xxh64_intdigest(h.tobytes(), 11)], np.uint64)
    runs = len(h) - words + 1
    acc = np.zeros(runs, np.uint64)
    for k in range(words):
        acc = acc * _U(0x9E3779B97F4A7C15) + h[k:k + runs]
    return np.unique(mix(acc))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """REGISTERS values of 16 bits: leading zeros and mantissa of each bucket's least hash."""
    k = _U(REGISTERS)
    bucket = (((hashes >> _U(32)) * k + (((hashes & _U(0xFFFFFFFF)) * k) >> _U(32))) >> _U(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))  # hashes are sorted, and so are buckets
    value = hashes[first] * k  # position within the bucket, 64 bits
    zeros = (53 - np.frexp((value >> _U(11)).astype(np.float64))[1]).astype(np.uint64)
    code = (zeros << _U(MANTISSA)) | ((value << (zeros + _U(1))) >> _U(64 - MANTISSA))
    out = np.zeros(REGISTERS, np.uint16)
    out[bucket[first]] = code
    if len(first) < REGISTERS:
        filled = bucket[first]
        empty = np.setdiff1d(np.arange(REGISTERS), filled, assume_unique=True)
        out[empty] = out[filled[RANKS[np.ix_(empty, filled)].argmin(axis=1)]]
    return out


def estimate(equal_share: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard estimate: the share of equal registers without those equal by chance."""
    ratio = np.asarray(n, float) / np.asarray(m, float)
    chance = _CHANCE * 4 * ratio / (1 + ratio) ** 2 / (1 << MANTISSA)
    return (equal_share - chance) / (1 - chance)


def least_estimate(percent: int) -> float:
    j = percent / 100
    return j - ESTIMATE_MARGIN * (j * (1 - j) / REGISTERS) ** 0.5


def may_link(est: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Pairs to compare on the full sets: by estimate, or by size where both sets are short."""
    short = np.maximum(n, m) <= EXACT
    return np.where(short, 100 * np.minimum(n, m) >= percent * np.maximum(n, m), est >= least_estimate(percent))


def linked(both: int, n: int, m: int, percent: int) -> bool:
    return 100 * both >= percent * (n + m - both)


def pack_set(hashes: np.ndarray) -> bytes:
    return (hashes >> _U(16)).astype("<u8").view("u1").reshape(-1, 8)[:, :6].tobytes()


def unpack_set(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, "u1").reshape(-1, 6)
    return np.pad(raw, ((0, 0), (0, 2))).view("<u8").ravel()


def text_key(text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16).digest()


def _slot(key: bytes) -> int:
    return xxhash.xxh64_intdigest(key, 42) % BITMAP_BITS  # Spark's xxhash64


def signature_batches(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[list] = [[], [], [], [], []]
        for t in batch.column(1):
            text = t.as_py().encode()
            h = shingles(text, words)
            some = len(h) > 0
            for column, v in zip(rows, (len(h), hashlib.blake2b(h.tobytes(), digest_size=16).digest() if some else None,
                                        text_key(text), sketch(h).tobytes() if some else None,
                                        h.tobytes() if 0 < len(h) <= EXACT else None)):
                column.append(v)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(rows[0], pa.int64()), *[pa.array(c, pa.binary()) for c in rows[1:]]],
            names=["doc_id", "n", "digest", "tkey", "sketch", "short"])


def run_class(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _U(64 - RUN_CLASS_BITS)).astype(np.int64)


def run_count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Short sets -> (class, n): how many of their runs are of a class."""
    total = np.zeros(1 << RUN_CLASS_BITS, np.int64)
    for batch in batches:
        runs = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64)
        total += np.bincount(run_class(runs), minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["class", "n"])


def first_runs(hashes: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The runs of a short set of which it shares one with every set it is linked with."""
    order = np.lexsort((hashes, counts[run_class(hashes)]))
    return hashes[order[:len(hashes) + (-percent * len(hashes)) // 100 + 1]]


def packed_runs(data: bytes) -> np.ndarray:
    """A packed set's hashes, the bits that were not kept zero."""
    return unpack_set(data) << _U(16)


def packed_count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, packed set) -> (class, n): how many of the runs are of a class."""
    total = np.zeros(1 << RUN_CLASS_BITS, np.int64)
    for batch in batches:
        for members in batch.column(1):
            total += np.bincount(run_class(packed_runs(members.as_py())), minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["class", "n"])


def rare_run_batches(batches: Iterator[pa.RecordBatch], counts: np.ndarray, percent: int) -> Iterator[pa.RecordBatch]:
    """(node, packed set) -> (key, node): a bucket for each of a set's rarest runs."""
    for batch in batches:
        for node, members in zip(batch.column(0).to_pylist(), batch.column(1)):
            keys = mix(first_runs(packed_runs(members.as_py()), counts, percent) + _U(0xD1B54A32D192ED03))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.full(len(keys), node))],
                                             names=["key", "node"])


def bucket_batches(batches: Iterator[pa.RecordBatch], counts: np.ndarray, percent: int) -> Iterator[pa.RecordBatch]:
    """(node, n, sketch, short) -> (key, node)."""
    bands = REGISTERS // ROWS
    weights = mix(np.arange(1, ROWS + 1, dtype=np.uint64)) | _U(1)
    for batch in batches:
        node, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        wide = 100 * n >= percent * (EXACT + 1)
        s = np.frombuffer(b"".join(batch.column(2).filter(pa.array(wide)).to_pylist()), "<u2")
        s = s.reshape(-1, bands, ROWS).astype(np.uint64)
        keys = [mix((s * weights).sum(axis=2, dtype=np.uint64) + mix(np.arange(bands, dtype=np.uint64) + _U(101))).ravel()]
        nodes = [np.repeat(node[wide], bands)]
        for i in np.flatnonzero(n <= EXACT):
            runs = first_runs(np.frombuffer(batch.column(3)[i].as_py(), np.uint64), counts, percent)
            keys.append(mix(runs + _U(0x9E3779B97F4A7C15)))
            nodes.append(np.repeat(node[i], len(runs)))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(nodes))],
                                         names=["key", "node"])


def estimate_batches(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """(a, b, na, nb, sa, sb) -> the pairs whose estimate doesn't rule them out."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b, na, nb = (batch.column(i).to_numpy() for i in range(4))
        sa, sb = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(-1, REGISTERS) for i in (4, 5))
        ok = may_link(estimate((sa == sb).mean(axis=1), na, nb), na, nb, percent)
        yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok])], names=["a", "b"])


def set_batches(batches: Iterator[pa.RecordBatch], words: int, bitmap: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Texts whose key is marked -> (tkey, packed set), each text once a task."""
    seen: set[bytes] = set()
    for batch in batches:
        keys, sets = [], []
        for t in batch.column(0):
            text = t.as_py().encode()
            key = text_key(text)
            at = _slot(key)
            if bitmap[at >> 3] >> (at & 7) & 1 and key not in seen:
                seen.add(key)
                keys.append(key)
                sets.append(pack_set(shingles(text, words)))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.binary())],
                                         names=["tkey", "members"])


def confirm_batches(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            x, y = unpack_set(x), unpack_set(y)
            ok.append(linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), percent))
        mask = pa.array(ok, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])


def tile_links(side, node, label, sketches, sets, percent: int) -> list[tuple[int, int]]:
    """Links between members of different labels: of side 0 with side 1, or all with all
    where there is one side. Labels that a link joins are one from then on."""
    label = label.copy()
    sizes = np.array([len(s) for s in sets])
    out = []
    two = len(np.unique(side)) == 2
    order = np.argsort(side, kind="stable")
    first = int((side == side[order[0]]).sum()) if two else 0
    for rank, i in enumerate(order[:first] if two else order[:-1]):
        others = order[first:] if two else order[rank + 1:]
        others = others[label[others] != label[i]]
        if not len(others):
            continue
        est = estimate((sketches[others] == sketches[i]).mean(axis=1), sizes[others], sizes[i])
        others = others[may_link(est, sizes[others], sizes[i], percent)]
        if not len(others):
            continue
        cat = np.concatenate([sets[j] for j in others])
        at = np.searchsorted(sets[i], cat)
        hit = sets[i][np.minimum(at, len(sets[i]) - 1)] == cat
        both = np.add.reduceat(hit.astype(np.int64), np.cumsum(sizes[others]) - sizes[others])
        for j, k in zip(others.tolist(), both.tolist()):
            if label[j] != label[i] and linked(k, int(sizes[i]), int(sizes[j]), percent):
                out.append((int(node[i]), int(node[j])))
                label[label == label[j]] = label[i]
    return out


def tile_batches(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, i, j) -> links of each tile."""
    held: list[dict] = []

    def links() -> pa.RecordBatch:
        found = tile_links(np.array([r["block"] for r in held]), np.array([r["node"] for r in held], np.int64),
                           np.array([r["label"] for r in held], np.int64),
                           np.frombuffer(b"".join(r["sketch"] for r in held), "<u2").reshape(-1, REGISTERS),
                           [unpack_set(r["members"]) for r in held], percent)
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()),
                                           pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

    for batch in batches:
        for row in batch.to_pylist():
            if held and (row["key"], row["i"], row["j"]) != (held[0]["key"], held[0]["i"], held[0]["j"]):
                yield links()
                held = []
            held.append(row)
    if held:
        yield links()


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links: label is the least node reachable."""
    pairs = stage(links.select(F.col("a").alias("u"), F.col("b").alias("v"))
                  .union(links.select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct(), "links")
    labels = stage(pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("l")), "labels")
    while True:
        near = pairs.join(labels.select(F.col("u").alias("v"), F.col("l").alias("lv")), "v").groupBy("u").agg(
            F.min("lv").alias("m"))
        low = labels.join(near, "u").select("u", F.col("l").alias("old"), F.least("l", "m").alias("l"))
        jump = labels.select(F.col("u").alias("l"), F.col("l").alias("ll"))
        labels = stage(low.join(jump, "l", "left").select("u", "old", F.least("l", "ll").alias("l")), "labels")
        if not labels.where(F.col("l") != F.col("old")).limit(1).count():
            return labels.select(F.col("u").alias("node"), F.col("l").alias("label"))
        labels = labels.select("u", "l")


def _several(left: DataFrame) -> DataFrame:
    """(key, c) of the buckets that hold several components, one of those with the very same members."""
    return (left.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("c"),
                                    F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("members"))
            .where("lo != hi").groupBy("c", "members", "lo", "hi").agg(F.min("key").alias("key")).select("key", "c"))


def _row_count(open_: DataFrame, tile: int) -> int:
    """Rows that ``tile_rows`` makes of these buckets."""
    return open_.agg(F.sum(F.col("c") * F.ceil(F.col("c") / F.lit(tile)))).first()[0] or 0


def open_buckets(left: DataFrame, labels: DataFrame, sets: DataFrame, percent: int, tile: int) -> tuple[DataFrame, DataFrame]:
    """(key, node, label) and (key, c) of the buckets to compare in tiles: those that still hold
    several components, the crowded ones dealt out anew by rare runs where that makes fewer rows."""
    open_ = stage(_several(left), "open")
    crowded, spark = open_.where(F.col("c") > 2 * tile), left.sparkSession
    before = _row_count(crowded, tile)
    if not before:
        return left, open_
    crowd = stage(left.join(crowded, "key").select("node").distinct(), "crowd")
    members = sets.join(crowd, "node").select("node", "members")
    counts = np.zeros(1 << RUN_CLASS_BITS, np.int64)  # a number a class, whatever the corpus
    found = members.mapInArrow(packed_count_batches, "class long, n long").groupBy("class").agg(F.sum("n").alias("n")).toPandas()
    counts[found["class"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    shared = spark.sparkContext.broadcast(counts)
    dealt = stage(members.mapInArrow(lambda it: rare_run_batches(it, shared.value, percent), "key long, node long")
                  .join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label")), "rare-runs")
    anew = stage(_several(dealt), "open-rare-runs")
    if _row_count(anew, tile) >= before:
        return left, open_
    few = open_.where(F.col("c") <= 2 * tile)
    return left.join(few.select("key"), "key").union(dealt.join(anew.select("key"), "key")), few.union(anew)


def tile_rows(left: DataFrame, open_: DataFrame, nodes: DataFrame, sets: DataFrame, tile: int) -> DataFrame:
    """A row for each member of an open bucket and tile that it is in."""
    blocks = F.ceil(F.col("c") / F.lit(tile))
    return (left.join(open_, "key").join(nodes.select("node", "sketch"), "node").join(sets, "node")
            .withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                    "block", "node", "label", "sketch", "members"))


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, tile: int = TILE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, keeper, tkey: one row per document. ``kept``
    is doc_id = component_id; ``keeper`` marks exactly one row of every group."""
    spark = docs.sparkSession
    ship(spark)
    n_parts = partitions_for(spark)
    texts = text_or_empty().alias("t")
    signed = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), texts)
                   .mapInArrow(lambda it: signature_batches(it, words),
                               "doc_id long, n long, digest binary, tkey binary, sketch binary, short binary")
                   .withColumn("row", F.monotonically_increasing_id()), "signatures")
    nodes = stage(signed.where("n > 0").groupBy("digest").agg(
        F.min("row").alias("node"), F.first("n").alias("n"), F.first("tkey").alias("tkey"),
        F.first("sketch").alias("sketch"), F.first("short").alias("short")), "nodes")

    counts = spark.sparkContext.broadcast(_run_counts(nodes.where("short IS NOT NULL").select("short")))
    bands = nodes.select("node", "n", "sketch", "short").mapInArrow(
        lambda it: bucket_batches(it, counts.value, percent), "key long, node long")
    shared = bands.groupBy("key").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("c")).where("c > 1")
    buckets = stage(bands.join(shared, "key"), "buckets")

    sketches = nodes.select("node", "n", "sketch")
    side = lambda c: sketches.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"))
    star = stage(buckets.where("node != least").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()
                 .join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "sa", "sb")
                 .mapInArrow(lambda it: estimate_batches(it, percent), "a long, b long"), "star")

    wanted = (star.select(F.col("a").alias("node")).union(star.select(F.col("b").alias("node")))
              .union(buckets.where("c > 2").select("node")).distinct().join(nodes.select("node", "tkey"), "node"))
    wanted = stage(wanted, "wanted")
    sets = _sets(docs.select(texts), wanted, words)
    member = lambda c: sets.select(F.col("node").alias(c), F.col("members").alias(f"m{c}"))
    confirm = lambda it: confirm_batches(it, percent)
    first = stage(star.join(member("a"), "a").join(member("b"), "b").select("a", "b", "ma", "mb")
                  .mapInArrow(confirm, "a long, b long"), "star-links")

    labels = components(first)
    left = stage(buckets.where("c > 2 and node != least").join(labels, "node", "left")
                 .select("key", "node", F.coalesce("label", "node").alias("label")), "open-buckets")
    left, open_ = open_buckets(left, labels, sets, percent, tile)
    rows = tile_rows(left, open_, nodes, sets, tile)
    more = stage(rows.repartition(n_parts, "key", "i", "j").sortWithinPartitions("key", "i", "j")
                 .mapInArrow(lambda it: tile_batches(it, percent), "a long, b long"), "tile-links")
    whole = components(first.union(more))

    grouped = (signed.select("row", "doc_id", "n", "digest", "tkey").join(nodes.select("digest", "node"), "digest", "left")
               .join(whole, "node", "left")
               .select("row", "doc_id", "n", "tkey", F.coalesce("label", "node", "row").alias("label"),
                       (F.col("n") == 0).alias("alone")))
    # Both staged: a join of two plain shuffles, in which Spark can split a hot group.
    grouped = stage(grouped.select("row", "doc_id", "n", "tkey", F.struct("alone", "label").alias("grp")), "grouped")
    heads = stage(grouped.groupBy("grp").agg(F.min("doc_id").alias("component_id"),
                                             F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("head")), "heads")
    return (grouped.join(heads, "grp")
            .select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
                    (F.col("row") == F.col("head.row")).alias("keeper"), "tkey"))


def _run_counts(short: DataFrame) -> np.ndarray:
    """Runs of the short sets by class: 2^RUN_CLASS_BITS numbers, whatever the corpus."""
    rows = short.mapInArrow(run_count_batches, "class long, n long").groupBy("class").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(1 << RUN_CLASS_BITS, np.int64)
    counts[rows["class"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return counts


def _bitmap(keys: DataFrame, key: str) -> np.ndarray:
    """BITMAP_BITS bits, whatever the corpus: the places of the keys (binary) are set."""
    at = F.pmod(F.xxhash64(key), F.lit(BITMAP_BITS)) + 1  # Spark's bitmaps count from 1
    marks = keys.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    bitmap = np.zeros(BITMAP_BITS // 8, np.uint8)
    for r in marks.collect():
        bits = np.frombuffer(r["bits"], np.uint8)
        bitmap[(r["bucket"] - 1) * len(bits):r["bucket"] * len(bits)] = bits
    return bitmap


def _sets(texts: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, members): packed sets of the wanted nodes, computed from their texts."""
    shared = texts.sparkSession.sparkContext.broadcast(_bitmap(wanted, "tkey"))
    found = texts.mapInArrow(lambda it: set_batches(it, words, shared.value), "tkey binary, members binary")
    return stage(found.dropDuplicates(["tkey"]).join(wanted, "tkey").select("node", "members"), "sets")


_KEY, _HIT = "__dedup_key", "__dedup_hit"


def row_key(doc_id: object, key: bytes) -> bytes:
    return hashlib.blake2b(repr(doc_id).encode() + b" " + key, digest_size=16).digest()


def decision_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, tkey, keeper) -> (key, keeper)."""
    for batch in batches:
        keys = [row_key(d, k) for d, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), batch.column(2)], names=["key", "keeper"])


def mark_batches(batches: Iterator[pa.RecordBatch], bitmap: np.ndarray, hits: bool) -> Iterator[pa.RecordBatch]:
    """The rows whose key is marked (with the key), or the others (as they are)."""
    for batch in batches:
        ids, texts = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "text"))
        keys = [row_key(d, text_key((t.as_py() or "").encode())) for d, t in zip(ids.to_pylist(), texts)]
        at = [_slot(k) for k in keys]
        hit = pa.array([bool(bitmap[a >> 3] >> (a & 7) & 1) == hits for a in at], pa.bool_())
        if hits:
            batch = pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())],
                                               names=[*batch.schema.names, _KEY])
        yield batch.filter(hit)


def deduplicate(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each group, with its own columns: the one of smallest doc_id.

    Most rows have nothing to do with a decision: those whose key isn't in a bitmap of the
    keys with a dropped row pass at once, so only the rest of the texts is shuffled."""
    spark = docs.sparkSession
    found = near_duplicates(docs, words, percent).select("doc_id", "tkey", "keeper").mapInArrow(
        decision_batches, "key binary, keeper boolean")
    drop = stage(found.groupBy("key").agg(F.max("keeper").alias("some"), F.min("keeper").alias("all"))
                 .where(~F.col("all")).select(F.col("key").alias(_KEY), "some"), "decisions")
    shared = spark.sparkContext.broadcast(_bitmap(drop, _KEY))
    typed = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    free = typed.mapInArrow(lambda it: mark_batches(it, shared.value, False), typed.schema)
    held = stage(typed.mapInArrow(lambda it: mark_batches(it, shared.value, True), T.StructType(
        [*typed.schema.fields, T.StructField(_KEY, T.BinaryType())])), "marked")
    decided = held.join(drop.withColumnRenamed("some", _HIT), _KEY, "left")
    # Not dropped after all; and of rows alike in id and text, of which one stays, one.
    other = decided.where(F.col(_HIT).isNull())
    alike = decided.where(F.col(_HIT)).dropDuplicates([_KEY])
    return free.unionByName(other.select(*typed.columns)).unionByName(alike.select(*typed.columns))
