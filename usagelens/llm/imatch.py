"""I-Match document fingerprints over randomised lexicons.

Terms are words (runs of bytes other than ASCII white space, A-Z lower-cased), by 64-bit
hash. The number of documents that hold a term is counted for every term over all documents. The
lexicon keeps terms whose inverse document frequency ln(N / df) is at least MIN_IDF and at most the upper
edge: the largest multiple of 1 / EDGE_STEPS, MAX_IDF at most, that leaves no more than MOST_TERMS
terms (8 MB). Terms of the band are in at least N / e^MAX_IDF documents, so there are at most
e^MAX_IDF (8103) times as many as a text has terms on average, however many documents. Terms
in so few documents (misspellings, numbers) decide nothing, nor do those in more than one of 20. A
text with fewer than MIN_TERMS terms of the band uses all its terms.

A fingerprint holds one byte for each of SUBSETS random lexicons. They come in rungs: at
a rung of 2^b cells a hash deals every term to one cell and the first CELLS cells are
lexicons of it, so the lexicons of a rung keep a 2^-b share of the terms each. Of a
text's distinct terms, sorted, those in a lexicon are hashed, in that order, to a byte (0: none). Small
rungs have many terms a lexicon and agree only for nearly equal texts; large ones have
few and still agree for texts that share a part.

``likeness`` of two fingerprints: of the lexicons that hold a term of either text, the
share with equal bytes, over the rungs where at most half of the lexicons are in use,
from the sparsest, until MIN_CELLS have been seen (denser rungs then follow). Equal
fingerprints have likeness 1; two without any term are equal.

The next document is found by runs: the keys (doc_id, text hash) are range-partitioned, the
first key of each of at most MOST_RUNS runs (17 bytes each, 2.2 MB in all) goes to the tasks, and
each row finds its run by binary search; texts are shuffled once, to their runs, and stream through.

Cases: a null text is the empty text; equal texts have equal fingerprints wherever they
stand; rows are ordered by doc_id, then text hash, null ids last; a single row is its own
next; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import ship, stage, text_or_empty, width
from usagelens.llm.neardup import HASHES, mix

MIN_IDF = 3.0
MAX_IDF = 9.0
EDGE_STEPS = 16
MOST_TERMS = 1 << 20
TERMS_HELD = 1 << 22
MIN_TERMS = 4
RUNGS = (4, 6, 8, 10, 12, 14)
CELLS = 32
MIN_CELLS = 16
DOCS_PER_TASK = 8192
MOST_RUNS = 1 << 17

_U = np.uint64
_USED = tuple(min(CELLS, 1 << b) for b in RUNGS)
_STARTS = np.concatenate([[0], np.cumsum(_USED)]).astype(np.int64)
SUBSETS = int(_STARTS[-1])
_SEEDS = mix(np.arange(1, len(RUNGS) + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


def terms(text: str) -> np.ndarray:
    """Sorted distinct term hashes."""
    found = set(text.encode().lower().split())
    return np.sort(np.frombuffer(b"".join(map(HASHES.__getitem__, found)), "<u8"))


def fingerprint(text: str, lexicon: np.ndarray) -> np.ndarray:
    """SUBSETS bytes; ``lexicon`` holds the terms of the band, sorted."""
    t = terms(text)
    if len(lexicon):
        at = np.minimum(np.searchsorted(lexicon, t), len(lexicon) - 1)
        inside = t[lexicon[at] == t]
        if len(inside) >= MIN_TERMS:
            t = inside
    out = np.zeros(SUBSETS, np.uint8)
    if not len(t):
        return out
    cells, marks = [], []
    for i, bits in enumerate(RUNGS):
        dealt = mix(t ^ _SEEDS[i])
        cell = (dealt >> _U(64 - bits)).astype(np.int64)
        ok = cell < _USED[i]
        cells.append(cell[ok] + _STARTS[i])
        marks.append(dealt[ok])
    cell, mark = np.concatenate(cells), np.concatenate(marks)
    if not len(cell):
        return out
    order = np.argsort(cell, kind="stable")  # terms of a lexicon stay in sorted order
    cell, mark = cell[order], mark[order]
    first = np.flatnonzero(np.diff(cell, prepend=-1))
    # A term's place in its lexicon's sorted list goes into its hash.
    place = np.arange(len(cell)) - np.repeat(first, np.diff(np.append(first, len(cell))))
    sums = mix(np.add.reduceat(mix(mark + place.astype(np.uint64)), first))
    out[cell[first]] = (sums % _U(255) + _U(1)).astype(np.uint8)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if np.array_equal(a, b):
        return 1.0
    used, same = (a > 0) | (b > 0), (a == b) & (a > 0)
    rungs = [(int(used[s:e].sum()), int(same[s:e].sum()), int(e - s)) for s, e in zip(_STARTS[:-1], _STARTS[1:])]
    seen = hit = 0
    for n, m, size in reversed(rungs):
        if 2 * n > size and seen >= MIN_CELLS:
            break
        seen, hit = seen + n, hit + m
    return hit / seen if seen else 0.0


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts -> (term, documents that hold it), summed over as many texts as TERMS_HELD terms allow."""
    held: list[np.ndarray] = []
    size = 0

    def counted() -> pa.RecordBatch:
        term, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n.astype(np.int64))], names=["term", "n"])

    for batch in batches:
        for t in batch.column(0):
            held.append(terms(t.as_py()))
            size += len(held[-1])
            if size >= TERMS_HELD:
                yield counted()
                held, size = [], 0
    if held:
        yield counted()


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(term, n): the documents that hold each term, over all rows; ``term`` is its hash."""
    ship(docs.sparkSession)
    return (docs.select(text_or_empty().alias("t")).mapInArrow(count_batches, "term long, n long")
            .groupBy("term").agg(F.sum("n").alias("n")))


def lexicon(docs: DataFrame, min_idf: float = MIN_IDF, max_idf: float = MAX_IDF, most: int = MOST_TERMS) -> np.ndarray:
    """The terms of the band, sorted: ``most`` at most."""
    idf = F.log(F.lit(float(docs.count())) / F.col("n"))
    step = F.greatest(F.ceil(idf * EDGE_STEPS), F.ceil(F.lit(min_idf * EDGE_STEPS)))
    band = stage(document_frequencies(docs).where((idf >= min_idf) & (idf <= max_idf))
                 .select("term", step.cast("int").alias("step")), "band")
    edge = room = 0
    for r in sorted(band.groupBy("step").count().collect()):  # a row for each step of the band
        room += r["count"]
        if room > most:
            break
        edge = r["step"]
    found = band.where(F.col("step") <= edge).select("term").toPandas()["term"].to_numpy(np.int64)
    return np.sort(found.view(_U))


def pair_batches(batches: Iterator[pa.RecordBatch], words: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of a bucket after another, in order; a row's next is the row below it. The
    rows past a bucket's end (``extra``) only serve the row above them."""
    held: tuple | None = None
    rows: list[list] = [[] for _ in range(7)]

    def pair(row: tuple, below: tuple) -> None:
        doc_id, text, mark = row[1], row[2], row[4]
        half = len(text) // 2
        edited = text[:len(text) - half] + below[2][:half]
        other = fingerprint(edited, words)
        for column, v in zip(rows, (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), mark.tobytes().hex(),
                                    other.tobytes().hex(), likeness(mark, other), likeness(mark, below[4]))):
            column.append(v)

    def flush() -> pa.RecordBatch:
        nonlocal rows
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names=[
            "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
        rows = [[] for _ in range(7)]
        return out

    for batch in batches:
        for bucket, doc_id, extra, text in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            row = (bucket, doc_id, text, extra, fingerprint(text, words))
            if held is not None and held[0] == bucket and not held[3]:
                pair(held, row)
            held = row
        yield flush()


def place_keys(z, d, h) -> np.ndarray:
    """(null, descending id, hash) as 17 bytes each that sort as the triples do."""
    out = np.empty((len(z), 17), np.uint8)
    out[:, 0] = np.asarray(z, bool) + 1  # never a zero byte in front
    for at, column in ((1, d), (9, h)):
        flipped = np.asarray(column, np.int64).view(np.uint64) ^ _U(1 << 63)
        out[:, at:at + 8] = flipped.astype(">u8").view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(out).view("S17").ravel()


def fingerprints(docs: DataFrame, words: np.ndarray | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next: every document against its edited text and the next document in
    descending doc_id (after the last, the first)."""
    spark = docs.sparkSession
    ship(spark)
    if words is None:
        words = lexicon(docs)
    shared = spark.sparkContext.broadcast(words)  # MOST_TERMS hashes
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("t")).select(
        "doc_id", F.xxhash64("t").alias("h"), "t")
    # Cut the order into runs: the first key of each of a range partitioning's parts.
    order = [F.col("doc_id").desc_nulls_last(), F.col("h")]
    keys = stage(texts.select("doc_id", "h"), "keys")
    parts = min(width(spark, keys.count(), DOCS_PER_TASK), MOST_RUNS)
    ranged = stage(keys.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "key-ranges")
    # Ascending form of the order: (null last, -doc_id, h).
    place = F.struct(F.col("doc_id").isNull().alias("z"), F.coalesce(F.bitwise_not("doc_id"), F.lit(0)).alias("d"), F.col("h"))
    firsts = sorted(tuple(r["p"]) for r in ranged.groupBy("part").agg(F.min(place).alias("p")).collect())  # MOST_RUNS at most
    bounds = spark.sparkContext.broadcast(place_keys(*(np.array(c) for c in zip(*firsts))) if firsts else place_keys([], [], []))

    @F.pandas_udf("long")
    def found(z: pd.Series, d: pd.Series, h: pd.Series) -> pd.Series:
        """Twice the row's run, and one more for a run's first key."""
        mine = place_keys(z.to_numpy(), d.to_numpy(), h.to_numpy())
        run = np.searchsorted(bounds.value, mine, side="right") - 1
        return pd.Series(2 * run + (bounds.value[np.maximum(run, 0)] == mine))

    placed = texts.withColumn("place", place)
    placed = placed.withColumn("found", found(F.col("place.z"), F.col("place.d"), F.col("place.h")))
    placed = placed.withColumn("bucket", F.floor(F.col("found") / 2).cast("int"))
    # A bucket's first key is also shown, as an extra, at the end of the bucket before.
    is_first = F.col("found") % 2 == 1
    before = F.pmod(F.col("bucket") - 1, F.lit(max(1, len(firsts))))
    rows = placed.withColumn("to", F.explode(F.when(is_first, F.array(
        F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("extra")),
        F.struct(before.alias("bucket"), F.lit(True).alias("extra")))).otherwise(
        F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("extra"))))))
    return (rows.select(F.col("to.bucket").alias("bucket"), "doc_id", F.col("to.extra").alias("extra"), "t", "place")
            .repartitionByRange(parts, "bucket").sortWithinPartitions("bucket", "extra", "place")
            .select("bucket", "doc_id", "extra", "t")
            .mapInArrow(lambda it: pair_batches(it, shared.value),
                        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                        "edited_fingerprint string, near_edited double, near_next double"))
