"""Exact top-k inner products by distributed histogram selection.

Every query is scored against every other vector, in blocks, several times over:

1. *Histograms.* Each task scores its candidates against a block of queries and counts
   the scores of every query in equal bins of the query's open interval. A task's own
   k-th best score is a lower bound of the global one, so it reports only its bins
   from the top down to k counts (what lies below cannot hold the k-th value). Added
   up, the bins tell in which one the k-th highest score lies; that bin is the next
   interval. 512 bins a round close any interval of 64-bit scores in at most eight.
2. *Filter.* With the k-th value known, a task gives off all candidates above it (fewer
   than k in all) and, of those equal to it, the smallest ids only, as many as are
   still missing. A last aggregate over these few rows ranks them, ties to smaller ids.

Candidates never move: they are read in place, split over tasks as the files are.
Queries go along in blocks of at most QUERY_BLOCK_BYTES of vectors; block after block,
whatever their number. Per query and task at most k bins or candidates are shuffled.

Scores are inner products of floor(256 x): exact in float64 when the product of the
largest magnitudes and the dimension stays below 2^53, else in Python integers.

Cases: a vector that is null, or holds a null or non-finite component, takes no part;
vectors of different length have no score with each other; a query whose id repeats is
answered once for each row, without the candidates of its own id; repeated candidate
rows compete as separate rows; scores beyond 64 bits stop at its ends; empty tables
give empty results; null ids take no part, as an answer could not name them.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from usagelens.llm.common import ship, stage
from usagelens.session import scratch_path

QUERY_BLOCK_BYTES = 4 << 20
QUERY_BLOCK_ROWS = 4096
BINS = 512
TILE_SCORES = 1 << 21
EXACT_FLOAT = float(1 << 53)

_LONG_MIN, _LONG_MAX = -(1 << 63), (1 << 63) - 1


def finite_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the rows that take part."""
    return (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
            .where(F.col("id").isNotNull() & F.col("v").isNotNull())
            .where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))))


def whole_numbers(x: np.ndarray) -> np.ndarray:
    """floor(256 x): float64 where that is exact, else Python integers."""
    x = x.astype(np.float64)
    if x.size == 0 or np.abs(x).max() < 2.0 ** 44:
        return np.floor(x * 256)
    return np.array([math.floor(Fraction(float(a)) * 256) for a in x.ravel()], object).reshape(x.shape)


def scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products as int64, stopped at the ends of 64 bits."""
    if queries.dtype != object and candidates.dtype != object and queries.size and candidates.size:
        if queries.shape[1] * np.abs(queries).max() * np.abs(candidates).max() < EXACT_FLOAT:
            return (queries @ candidates.T).astype(np.int64)
    if queries.shape[1] == 0:
        return np.zeros((len(queries), len(candidates)), np.int64)
    a, b = (np.array([[int(v) for v in row] for row in m.tolist()], object) for m in (queries, candidates))
    return np.clip(a @ b.T, _LONG_MIN, _LONG_MAX).astype(np.int64)


class QueryBlock:
    """Queries of one block, by dimension: (numbers, ids, matrix)."""

    def __init__(self, rows: list):
        self.n = len(rows)
        self.ids = np.array([r["id"] for r in rows], np.int64)
        by_dim: dict[int, list[int]] = defaultdict(list)
        for i, r in enumerate(rows):
            by_dim[len(r["v"])].append(i)
        self.parts = {d: (np.array(at), whole_numbers(np.array([rows[i]["v"] for i in at], np.float64).reshape(len(at), d)))
                      for d, at in by_dim.items()}

    def tiles(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(query numbers, candidate ids, scores, mask of pairs that count) for all pairs."""
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            lists = batch.column(1)
            dims = lists.value_lengths().to_numpy(zero_copy_only=False)
            values = lists.flatten().to_numpy(zero_copy_only=False)
            starts = np.cumsum(dims) - dims
            for d in np.unique(dims).tolist():
                if d not in self.parts:
                    continue
                numbers, matrix = self.parts[d]
                rows = np.flatnonzero(dims == d)
                size = max(1, TILE_SCORES // len(numbers))
                for at in range(0, len(rows), size):
                    r = rows[at:at + size]
                    c = whole_numbers(values[(starts[r][:, None] + np.arange(d)).astype(np.int64)])
                    other = ids[r]
                    yield numbers, other, scores(matrix, c), self.ids[numbers][:, None] != other[None, :]


def _offset(x: np.ndarray, low: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64) - low.astype(np.uint64)  # exact modulo 2^64


def histogram_batches(batches, block: QueryBlock, low, high, step, missing) -> Iterator[pa.RecordBatch]:
    """Counts of scores in [low, high] per query and bin, from the top bin down to
    ``missing`` counts."""
    total = np.zeros((block.n, BINS), np.int64)
    for numbers, _, s, counts in block.tiles(batches):
        lo = low[numbers][:, None]
        inside = counts & (s >= lo) & (s <= high[numbers][:, None])
        q, c = np.nonzero(inside)
        if len(q) == 0:
            continue
        bins = (_offset(s[q, c], low[numbers][q]) // step[numbers][q].astype(np.uint64)).astype(np.int64)
        total[numbers] += np.bincount(q * BINS + bins, minlength=len(numbers) * BINS).reshape(len(numbers), BINS)
    above = np.cumsum(total[:, ::-1], axis=1)[:, ::-1] - total  # counts in higher bins
    q, b = np.nonzero((total > 0) & (above < missing[:, None]))
    yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(b, pa.int32()), pa.array(total[q, b], pa.int64())],
                                     names=["no", "bin", "n"])


def filter_batches(batches, block: QueryBlock, kth, ties) -> Iterator[pa.RecordBatch]:
    """Candidates above the k-th value, and per task the ``ties`` smallest ids at it."""
    equal: dict[int, list[int]] = defaultdict(list)
    schema = pa.schema([("no", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])
    for numbers, other, s, counts in block.tiles(batches):
        limit = kth[numbers][:, None]
        q, c = np.nonzero(counts & (s > limit))
        if len(q):
            yield pa.RecordBatch.from_arrays([pa.array(numbers[q], pa.int32()), pa.array(other[c]), pa.array(s[q, c])],
                                             schema=schema)
        hit = counts & (s == limit)
        for i in np.flatnonzero(hit.any(axis=1)).tolist():
            no = int(numbers[i])
            equal[no] = heapq.nsmallest(int(ties[no]), equal[no] + other[hit[i]].tolist())
    rows = [(no, v) for no, ids in equal.items() for v in ids]
    yield pa.RecordBatch.from_arrays(
        [pa.array([no for no, _ in rows], pa.int32()), pa.array([v for _, v in rows], pa.int64()),
         pa.array([int(kth[no]) for no, _ in rows], pa.int64())], schema=schema)


def _length(row: list) -> float:
    try:
        return math.sqrt(sum(float(v) * float(v) for v in row))
    except OverflowError:
        return math.inf


def _kth_values(candidates: DataFrame, block: QueryBlock, reach: float, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(k-th highest score of each query, how many equal to it are still needed); with
    fewer than k candidates the value is the lowest there can be, and all are needed."""
    bound = np.zeros(block.n)
    for numbers, matrix in block.parts.values():
        bound[numbers] = [_length(row) * reach if len(row) else 0.0 for row in matrix.tolist()]
    top = [_LONG_MAX if not b < 2.0 ** 62 else int(b * 1.000001) + 2 for b in bound.tolist()]
    low = np.array([max(_LONG_MIN, -t) for t in top], np.int64)
    low[np.array([t == _LONG_MAX for t in top], bool)] = _LONG_MIN
    high = np.array(top, np.int64)
    missing, few = np.full(block.n, k, np.int64), np.zeros(block.n, bool)
    open_ = np.ones(block.n, bool)
    while open_.any():
        wide = [(int(h) - int(lo)) // BINS + 1 for lo, h in zip(low, high)]
        step = np.array(wide, np.int64)
        lo, hi, need = low.copy(), np.where(open_, high, low - (low > _LONG_MIN)), missing.copy()
        bins = (candidates.mapInArrow(lambda it, a=lo, b=hi, c=step, m=need: histogram_batches(it, block, a, b, c, m),
                                      "no int, bin int, n long")
                .groupBy("no", "bin").agg(F.sum("n").alias("n")))
        from_top = W.partitionBy("no").orderBy(F.desc("bin"))  # at most BINS rows a query
        found = (bins.withColumn("upto", F.sum("n").over(from_top))
                 .join(F.broadcast(_numbers(candidates, need)), "no")  # QUERY_BLOCK_ROWS rows at most
                 .where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need")))
                 .select("no", "bin", (F.col("upto") - F.col("n")).alias("over"))).collect()  # a row a query
        located = {r["no"]: r for r in found}
        for i in np.flatnonzero(open_).tolist():
            if i not in located:  # fewer than k candidates in all
                few[i], open_[i] = True, False
                continue
            r = located[i]
            low[i], high[i] = int(lo[i]) + r["bin"] * int(step[i]), min(
                int(high[i]), int(lo[i]) + (r["bin"] + 1) * int(step[i]) - 1)
            missing[i] -= r["over"]
            open_[i] = low[i] < high[i]
    low[few] = _LONG_MIN
    missing[few] = k
    return low, missing


def _numbers(candidates: DataFrame, need: np.ndarray) -> DataFrame:
    return candidates.sparkSession.createDataFrame(list(enumerate(need.tolist())), "no int, need long")


def top_k(vectors: DataFrame, is_query, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows for each row that the Column
    ``is_query`` (over ``id``) selects."""
    spark = vectors.sparkSession
    ship(spark)
    candidates = finite_vectors(vectors, id_col, vector_col)
    queries = stage(candidates.where(is_query).withColumn("no", F.monotonically_increasing_id()), "topk-queries")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + F.pow(F.abs(x.cast("double")) * 256 + 1, F.lit(2.0)))
    size = queries.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("v") * 8 + 16).alias("bytes")).first()
    reach = math.sqrt(candidates.agg(F.max(square).alias("m")).first()["m"] or 0.0)
    blocks = max(1, -(-(size["bytes"] or 0) // QUERY_BLOCK_BYTES), -(-size["n"] // QUERY_BLOCK_ROWS)) * 2
    if size["n"] <= QUERY_BLOCK_ROWS // 2 and (size["bytes"] or 0) <= QUERY_BLOCK_BYTES // 2:
        blocks = 1
    path = scratch_path(spark, "topk")
    for b in range(blocks):  # hashing fills a block to about half of its bound
        rows = queries.where(F.pmod(F.xxhash64("no"), F.lit(blocks)) == b).collect()
        block = QueryBlock(rows)
        kth, ties = _kth_values(candidates, block, reach, k) if rows else (np.zeros(0, np.int64),) * 2
        best = candidates.mapInArrow(lambda it, q=block, v=kth, t=ties: filter_batches(it, q, v, t) if q.n else iter(()),
                                     "no int, vec_id long, score long")
        names = spark.createDataFrame(list(enumerate(block.ids.tolist())), "no int, query_id long")
        ranked = (best.withColumn("rank", F.row_number().over(W.partitionBy("no").orderBy(F.desc("score"), "vec_id")))
                  .where(F.col("rank") <= k).join(F.broadcast(names), "no"))  # QUERY_BLOCK_ROWS rows at most
        ranked.select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(path)
    return spark.read.schema("query_id long, rank int, vec_id long, score long").parquet(path)
