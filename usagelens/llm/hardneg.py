"""Hard negatives of anchor vectors, by score bounds along a spanning tree of the anchors.

An anchor's positives are its best other rows of the same label. For each positive, the
hard negatives are the best rows of another label whose score lies in a window below the
positive's. Two passes over tiles of anchors and candidates find them: the positives, then, with
their scores known, the negatives.

*Trees.* Anchors of one label and length are dealt into groups of about TREE_ROWS, and each
group gets a minimum spanning tree. A candidate's score at a child differs from its score at
the parent by at most the edge's length times the candidate's norm. In a tile a tree is
walked from the root, where every candidate is scored; below, each candidate has an interval of
scores, and only those whose interval meets the anchor's windows (or, for positives, reaches the
k-th best so far) are scored again, which closes their interval for the children.

*Tiles.* Candidates are dealt by row into blocks of at most about CANDIDATE_BYTES, trees into
blocks of about ANCHOR_BYTES; a tile is one block of each, brought together by a cogroup, so no
data passes through the driver and a lost tile is computed again alone. The candidates of a
positives tile are only those of its anchors' labels. A label, vector or id of a third of all rows
is dealt over blocks like any other; equal anchors are counted and answered once. A tile gives
off k rows a window at most, and a ranking of these ends each pass.

Scores are inner products of floor(256 x): exact in float64 when the product of the largest
magnitudes and the dimension stays below 2^53; a tile beyond that scores everything in Python
integers, without bounds.

Cases: rows with a null id, label or vector, or a null or non-finite component take no part;
vectors of different length have no score with each other; rows of an anchor's own id are neither
its positives nor its negatives; an anchor whose id repeats is answered once for each row;
repeated rows compete as separate rows; a negative positive score has an empty window; scores beyond
64 bits stop at its ends; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from usagelens.llm.common import partitions_for, ship, stage, unfold
from usagelens.llm.topk import EXACT_FLOAT, scores, whole_numbers

TREE_ROWS = 192
ANCHOR_BYTES = 2 << 20
CANDIDATE_BYTES = 8 << 20
CANDIDATES_PER_STEP = 8192
FEWEST_PER_BLOCK = 2048
_ROUND = 1 + 1e-9

_FOUND = pa.schema([("no", pa.int64()), ("place", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])


def taking_part(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, v, dim) of the rows that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                          F.col(vector_col).alias("v"))
    return (rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull())
            .where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
            .withColumn("dim", F.size("v")))


def matrix(lists: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    return whole_numbers(lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), dim))


def spanning_tree(points: np.ndarray) -> tuple[list[int], list[int], list[float]]:
    """Prim's tree: (points in the order they join, the place of each one's parent in that order
    or -1, length of the edge)."""
    n = len(points)
    order, parent, edge = [0], [-1], [0.0]
    place, nearest = np.zeros(n, np.int64), np.full(n, np.inf)
    done = np.zeros(n, bool)
    done[0], at = True, 0
    for k in range(1, n):
        away = np.linalg.norm(points - points[at], axis=1)
        closer = ~done & (away < nearest)
        nearest[closer], place[closer] = away[closer], k - 1
        at = int(np.argmin(np.where(done, np.inf, nearest)))
        if done[at]:  # only infinite distances are left
            at = int(np.argmin(done))
        order.append(at)
        parent.append(int(place[at]))
        edge.append(float(nearest[at]))
        done[at] = True
    return order, parent, edge


def _plant(group: pa.Table) -> pa.Table:
    """The anchors of one tree, parents first."""
    group = group.sort_by([("id", "ascending"), ("row", "ascending")])
    dim = group.column("dim")[0].as_py()
    points = matrix(group.column("v"), dim).astype(np.float64)
    with np.errstate(all="ignore"):
        order, parent, edge = spanning_tree(np.nan_to_num(points))
    group = group.take(pa.array(order)).drop_columns(["row"])
    return (group.append_column("node", pa.array(range(len(order)), pa.int32()))
            .append_column("parent", pa.array(parent, pa.int32())).append_column("edge", pa.array(edge, pa.float64())))


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (score, id), ties to smaller ids."""
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        kept = score >= least
        score, ids = score[kept], ids[kept]
    order = np.lexsort((ids, -score))[:k]
    return score[order], ids[order]


class _Want:
    """What one anchor is after: the best k overall (``windows`` None), or in each window."""

    def __init__(self, windows: list[tuple[int, int]] | None, k: int):
        self.k, self.windows = k, windows
        none = np.zeros(0, np.int64)
        self.best = [(none, none)] * (1 if windows is None else len(windows))
        open_ = [w for w in windows or () if w[0] <= w[1]]
        self.low = min((w[0] for w in open_), default=None)
        self.high = max((w[1] for w in open_), default=None)

    def meets(self, lo: np.ndarray, hi: np.ndarray, may: np.ndarray) -> np.ndarray:
        """Which of the candidates ``may`` can belong to the result, by bounds of their scores."""
        if self.windows is not None:
            return may & (hi >= self.low) & (lo <= self.high) if self.low is not None else np.zeros(len(may), bool)
        had, floor = self.best[0][0], -np.inf
        if len(had) == self.k:
            floor = float(had[-1])
        sure = lo[may]
        if len(sure) >= self.k:
            floor = max(floor, float(np.partition(sure, len(sure) - self.k)[len(sure) - self.k]))
        return may & (hi >= floor)

    def take(self, score: np.ndarray, ids: np.ndarray) -> None:
        for i, window in enumerate(self.windows if self.windows is not None else [None]):
            s, c = score, ids
            if window is not None:
                inside = (s >= window[0]) & (s <= window[1])
                s, c = s[inside], c[inside]
            if len(s):
                had = self.best[i]
                self.best[i] = _best(np.concatenate([had[0], s]), np.concatenate([had[1], c]), self.k)


def walk(points: np.ndarray, parents: list[int], edges: list[float], own: list[int], wants: list[_Want],
         candidates: np.ndarray, ids: np.ndarray) -> int:
    """Bring one tree's anchors and candidates together; returns how many scores were computed."""
    norms = np.sqrt((candidates * candidates).sum(axis=1)) * _ROUND
    left = np.bincount([p for p in parents if p >= 0], minlength=len(parents))
    bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    count = 0
    for i, p in enumerate(parents):
        may = ids != own[i]
        if p < 0:
            lo = candidates @ points[i]
            hi = lo.copy() if left[i] else lo
            hit = np.flatnonzero(may)
            count += len(ids)
        else:
            reach = norms * (edges[i] * _ROUND) + 0.5  # scores are whole: half a unit covers rounding
            lo, hi = bounds[p][0] - reach, bounds[p][1] + reach
            hit = np.flatnonzero(wants[i].meets(lo, hi, may))
            lo[hit] = hi[hit] = candidates[hit] @ points[i]
            count += len(hit)
            left[p] -= 1
            if not left[p]:
                del bounds[p]
        wants[i].take(lo[hit].astype(np.int64), ids[hit])
        if left[i]:
            bounds[i] = lo, hi
    return count


def windows_of(positive_scores: list[int], low: int, high: int) -> list[tuple[int, int]]:
    """low * score <= 100 * s <= high * score, as whole-number bounds of s."""
    return [(-(-low * s // 100), high * s // 100) for s in positive_scores]


def tile(candidates: pa.Table, anchors: pa.Table, k: int, percent: tuple[int, int] | None) -> pa.Table:
    """Local results of one tile: positives (``percent`` None) or negatives in each positive's window."""
    empty = _FOUND.empty_table()
    if not candidates.num_rows or not anchors.num_rows:
        return empty
    dim = anchors.column("dim")[0].as_py()
    candidates = candidates.sort_by("label")
    rows, ids = matrix(candidates.column("v"), dim), candidates.column("id").to_numpy()
    labels = candidates.column("label").to_numpy()
    anchors = anchors.sort_by([("label", "ascending"), ("tree", "ascending"), ("node", "ascending")])
    points = matrix(anchors.column("v"), dim)
    a = {c: anchors.column(c).to_pylist() for c in ("no", "id", "label", "tree", "parent", "edge")}
    positives = None if percent is None else anchors.column("positives").to_pylist()
    exact = rows.dtype != object and points.dtype != object and (
        dim == 0 or dim * np.abs(rows).max() * np.abs(points).max() < EXACT_FLOAT)

    out: list[tuple] = []
    starts = [i for i in range(len(points)) if a["parent"][i] < 0] + [len(points)]
    for first, end in zip(starts, starts[1:]):
        wants = [_Want(None if percent is None else windows_of([x["score"] for x in positives[i]], *percent), k)
                 for i in range(first, end)]
        one, two = np.searchsorted(labels, [a["label"][first], a["label"][first] + 1])
        spans = [(one, two)] if percent is None else [(0, one), (two, len(labels))]
        for low, high in spans:
            for at in range(low, high, CANDIDATES_PER_STEP):
                part = slice(at, min(high, at + CANDIDATES_PER_STEP))
                if exact:
                    walk(points[first:end], a["parent"][first:end], a["edge"][first:end], a["id"][first:end], wants,
                         rows[part], ids[part])
                    continue
                for i in range(first, end):
                    may = ids[part] != a["id"][i]
                    wants[i - first].take(scores(points[i:i + 1], rows[part])[0][may], ids[part][may])
        for i, want in zip(range(first, end), wants):
            out += [(a["no"][i], j, c, s) for j, (score, best) in enumerate(want.best) for s, c in zip(score.tolist(), best.tolist())]
    if not out:
        return empty
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), _FOUND)], schema=_FOUND)


def _blocks(rows: DataFrame, block_bytes: int, least: Column) -> DataFrame:
    """(dim, blocks) for each length of vectors."""
    sizes = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"))
    by_bytes = F.ceil(F.col("n") * (F.col("dim") + 2) * 8 / F.lit(block_bytes))
    return sizes.select("dim", F.greatest(by_bytes, least, F.lit(1)).cast("int").alias("blocks"))


def plant_trees(rows: DataFrame, is_anchor: Column, tree_rows: int = TREE_ROWS, block_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """The anchors, equal ones counted, with their place in their tree."""
    anchors = rows.where(is_anchor).groupBy("id", "label", "v", "dim").agg(F.count(F.lit(1)).alias("copies"))
    anchors = stage(anchors.withColumn("row", F.monotonically_increasing_id()), "negatives-anchors")
    trees = anchors.groupBy("dim", "label").agg(F.ceil(F.count(F.lit(1)) / tree_rows).cast("int").alias("trees"))
    dealt = (anchors.join(trees, ["dim", "label"]).join(_blocks(anchors, block_bytes, F.lit(1)), "dim")
             .withColumn("tree", F.pmod(F.xxhash64("row"), F.col("trees")).cast("int"))
             .withColumn("block", F.pmod(F.xxhash64("label", "tree"), F.col("blocks")).cast("int"))
             .withColumn("v", F.col("v").cast("array<double>")))
    planted = (dealt.select("id", "label", "copies", "dim", "block", "tree", "row", "v").groupBy("dim", "label", "tree")
               .applyInArrow(_plant, "id long, label long, copies long, dim int, block int, tree int, v array<double>, "
                                     "node int, parent int, edge double"))
    return stage(planted.withColumn("no", F.monotonically_increasing_id()), "negatives-trees")


def _pass(rows: DataFrame, anchors: DataFrame, blocks: DataFrame, by: list[str], k: int,
          percent: tuple[int, int] | None) -> DataFrame:
    """(no, place, id, score, rank) over all tiles. A candidate goes to the blocks of anchors that share its ``by``."""
    parts = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("dim", "part")
    cand = rows.join(blocks, "dim").withColumn("part", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    fresh = anchors.select(*[F.col(c).alias(c) for c in anchors.columns])  # two readings of one table meet in the cogroup
    wanted = fresh.select("block", *by).distinct().join(parts, "dim")
    cand = cand.select("id", "label", "dim", "part", F.col("v").cast("array<double>").alias("v")).join(wanted, [*by, "part"])
    near = anchors.join(parts, "dim")
    key = ["dim", "block", "part"]
    found = cand.groupBy(*key).cogroup(near.groupBy(*key)).applyInArrow(
        lambda c, a: tile(c, a, k, percent), "no long, place int, id long, score long")
    best = W.partitionBy("no", "place").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80,
                   high: int = 100, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   tree_rows: int = TREE_ROWS, candidate_bytes: int = CANDIDATE_BYTES, anchor_bytes: int = ANCHOR_BYTES
                   ) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each row that
    ``is_anchor`` (over ``id``) selects and each of its ``positives`` best rows of the same label, the
    ``negatives`` best rows of other labels with low * positive <= 100 * negative <= high * positive."""
    spark = vectors.sparkSession
    ship(spark)
    rows = taking_part(vectors, id_col, vector_col, label_col)
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "negatives-rows")
    anchors = plant_trees(rows, is_anchor, tree_rows, anchor_bytes)
    spread = F.least(F.lit(partitions_for(spark)), F.ceil(F.col("n") / FEWEST_PER_BLOCK))
    blocks = _blocks(rows, candidate_bytes, spread)

    best = _pass(rows, anchors, blocks, ["dim", "label"], positives, None)
    in_order = F.array_sort(F.collect_list(F.struct("rank", "id", "score")))  # ``positives`` elements at most
    known = best.groupBy("no").agg(F.transform(in_order, lambda p: F.struct(p["id"].alias("id"), p["score"].alias("score"))).alias("positives"))
    with_positives = stage(anchors.join(known, "no"), "negatives-positives")

    found = _pass(rows, with_positives, blocks, ["dim"], negatives, (low, high))
    named = with_positives.select("no", F.col("id").alias("anchor_id"), "copies", F.posexplode("positives").alias("place", "p"))
    out = found.join(named, ["no", "place"]).select(
        "anchor_id", F.col("p.id").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"), "copies", "no", "place")
    return unfold(out, "no", "place", "rank").drop("copies", "copy", "no", "place")
