"""Text quality by Naive Bayes support vectors.

Features of a text are indicators of hashed n-grams: three-byte runs, words, pairs of
neighbouring words (case kept), and runs of REPEATS marks that tell for each word whether
it repeats the one before; FEATURES places in all. An indicator is scaled by its
log-count ratio r = log((a + count in good) / |good| over (a + count in poor) / |poor|),
the vector is brought to unit length, and a linear model is fitted to squared hinge loss
by dual coordinate descent: one example at a time moves its dual variable to the optimum
with the others fixed and updates the weights. The weights are mixed with their mean
magnitude (INTERPOLATION), as is usual for this model. A logistic curve through margins
that each row gets from a model of the other folds, and the class shares of all labelled
rows, turn a margin into a score.

The fit uses at most SAMPLE_PER_CLASS labelled rows a class, those with the least hash
of their id, so its cost and what one task holds are bounded; scoring reads all rows.

Cases: a null or empty text has no feature, its margin is 0; a doc_id labelled more than
once counts as poor when any label says so; null labels are left out; without rows of
both classes every text gets the smoothed share of good labels; an empty table gives an
empty result; a missing doc_id is held out (its remainder is unknown) and scored like
any other; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import ship, text_or_empty
from usagelens.llm.neardup import HASHES, mix

FEATURE_BITS = 19
FEATURES = 1 << FEATURE_BITS
SAMPLE_PER_CLASS = 4000
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 8
FOLDS = 4
REPEATS = 4
INTERPOLATION = 0.25
THRESHOLD = 0.3

_U = np.uint64


def features(text: str) -> np.ndarray:
    """Distinct feature places of a text, ascending."""
    data = text.encode()
    b = np.frombuffer(data, np.uint8).astype(np.uint64)
    runs = b[:-2] | (b[1:-1] << _U(8)) | (b[2:] << _U(16))
    h = np.frombuffer(b"".join(map(HASHES.__getitem__, data.split())), "<u8")
    pairs = h[:-1] * _U(0x9E3779B97F4A7C15) + h[1:] if len(h) > 1 else h[:0]
    again = (h[1:] == h[:-1]).astype(np.uint64)  # is the word the one before it?
    many = max(0, len(again) - REPEATS + 1)
    repeats = sum((again[k:k + many] << _U(k) for k in range(REPEATS)), np.zeros(many, np.uint64))
    keys = np.concatenate([(runs + _U(1)) * _U(0xD6E8FEB86659FD93), h, mix(pairs + _U(3)),
                           mix(np.unique(repeats) + _U(0xA24BAED4963EE407))])
    return np.unique((mix(keys) >> _U(64 - FEATURE_BITS)).astype(np.int32))


class Model:
    """scale (r), weights over scaled features, and the curve's slope and offset."""

    def __init__(self, scale: np.ndarray, weights: np.ndarray, slope: float, offset: float):
        self.squares = (scale ** 2).astype(np.float32)
        self.product = (scale * weights).astype(np.float32)
        self.slope, self.offset = slope, offset

    def margin(self, at: np.ndarray) -> float:
        norm = float(np.sqrt(self.squares[at].sum(dtype=np.float64)))
        return float(self.product[at].sum(dtype=np.float64)) / norm if norm else 0.0

    def score(self, at: np.ndarray) -> float:
        z = min(500.0, max(-500.0, self.slope * self.margin(at) + self.offset))
        return float(1 / (1 + np.exp(-z)))


def log_count_ratios(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    counts = [np.full(FEATURES, SMOOTHING), np.full(FEATURES, SMOOTHING)]
    for at, y in zip(rows, good):
        counts[int(y)][at] += 1
    return np.log((counts[1] / counts[1].sum()) / (counts[0] / counts[0].sum()))


def dual_coordinate_descent(rows: list[np.ndarray], scale: np.ndarray, good: np.ndarray, cost: float = COST,
                            epochs: int = EPOCHS) -> np.ndarray:
    """Weights minimising |w|^2 / 2 + cost * sum(max(0, 1 - y w.x)^2), x of unit length."""
    w, dual = np.zeros(FEATURES), np.zeros(len(rows))
    values = []
    for at in rows:
        v = scale[at]
        norm = np.sqrt((v ** 2).sum())
        values.append(v / norm if norm else v)
    sign = np.where(good > 0, 1.0, -1.0)
    diagonal = np.array([(v ** 2).sum() for v in values]) + 1 / (2 * cost)
    order = np.random.default_rng(20260101)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, v, y = rows[i], values[i], sign[i]
            slope = y * (w[at] @ v) - 1 + dual[i] / (2 * cost)
            new = max(0.0, dual[i] - slope / diagonal[i])
            if new != dual[i]:
                w[at] += (new - dual[i]) * y * v
                dual[i] = new
    return (1 - INTERPOLATION) * np.abs(w).mean() + INTERPOLATION * w


def logistic_curve(margins: np.ndarray, good: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset by Newton steps, towards smoothed targets so that both stay finite."""
    up, down = good.sum(), len(good) - good.sum()
    goal = np.where(good > 0, (up + 1) / (up + 2), 1 / (down + 2))
    unit = max(1e-12, float(np.abs(margins).max(initial=0)))
    x = np.column_stack([margins / unit, np.ones(len(margins))])
    beta = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -500, 500)))
        curve = x.T @ (x * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, x.T @ (goal - p) - 1e-6 * beta)
        beta += np.clip(step, -4, 4)
    return float(max(0.0, beta[0]) / unit), float(beta[1])


def _weigh(rows: list[np.ndarray], good: np.ndarray) -> Model:
    scale = log_count_ratios(rows, good)
    return Model(scale, dual_coordinate_descent(rows, scale, good), 1.0, 0.0)


def fit(rows: list[np.ndarray], good: np.ndarray) -> Model:
    """The model of all rows; its curve from margins that models of the other folds give."""
    fold = np.zeros(len(rows), np.int64)
    for y in (0, 1):  # every fold gets its part of both classes
        at = np.flatnonzero(good == y)
        fold[at] = np.arange(len(at)) % FOLDS
    model, margins = _weigh(rows, good), np.full(len(rows), np.nan)
    for k in range(FOLDS):
        inside = fold != k
        if 0 < good[inside].sum() < inside.sum():
            other = _weigh([r for r, i in zip(rows, inside) if i], good[inside])
            for i in np.flatnonzero(~inside):
                margins[i] = other.margin(rows[i])
    known = ~np.isnan(margins)
    if not 0 < good[known].sum() < known.sum():  # too few rows for folds
        margins, known = np.array([model.margin(r) for r in rows]), np.ones(len(rows), bool)
    model.slope, model.offset = logistic_curve(margins[known], good[known])
    return model


def feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([features(t.as_py()).tobytes() for t in batch.column(2)], pa.binary())],
            names=["doc_id", "good", "at"])


def fit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All sampled rows (one task) -> one row with the model."""
    frame = pd.concat([b.to_pandas() for b in batches] or [pd.DataFrame({"doc_id": [], "good": [], "at": []})])
    frame = frame.sort_values(["doc_id", "at"]).sample(frac=1.0, random_state=20260101)
    good = frame["good"].to_numpy(np.int64)
    if len(good) and 0 < good.sum() < len(good):
        m = fit([np.frombuffer(a, np.int32) for a in frame["at"]], good)
        row = {"squares": m.squares.tobytes(), "product": m.product.tobytes(), "slope": m.slope, "offset": m.offset}
        yield pa.RecordBatch.from_pylist([row], schema=pa.schema(
            [("squares", pa.binary()), ("product", pa.binary()), ("slope", pa.float64()), ("offset", pa.float64())]))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """The model of the labelled rows that are not held out."""
    spark = docs.sparkSession
    ship(spark)
    known = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("good")))
    shares = {r["good"]: r["count"] for r in known.groupBy("good").count().collect()}  # two rows
    n0, n1 = shares.get(0, 0), shares.get(1, 0)
    least = lambda y: known.where(F.col("good") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
    sample = least(0).unionByName(least(1))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("t"))
            .join(F.broadcast(sample), "doc_id")  # at most 2 * per_class rows
            .select("doc_id", "good", "t").mapInArrow(feature_batches, "doc_id long, good int, at binary"))
    got = rows.repartition(1).mapInArrow(fit_batches, "squares binary, product binary, slope double, offset double").collect()
    if not got:
        zero = np.zeros(FEATURES)
        return Model(zero, zero, 0.0, float(np.log((n1 + 1) / (n0 + 1))))
    model = Model(np.zeros(1), np.zeros(1), got[0]["slope"], got[0]["offset"])
    model.squares, model.product = (np.frombuffer(got[0][c], np.float32) for c in ("squares", "product"))
    # From the sample's class shares to those of all labelled rows.
    model.offset += float(np.log((n1 / min(n1, per_class)) / (n0 / min(n0, per_class))))
    return model


def score_batches(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = [model.score(features(t.as_py())) for t in batch.column(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())],
                                         names=[*batch.schema.names[:-1], "score"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two arrays of FEATURES floats
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("t"))
            .mapInArrow(lambda it: score_batches(it, shared.value), "doc_id long, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows whose score reaches THRESHOLD, with their own columns."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            good = [shared.value.score(features(t.as_py() or "")) >= THRESHOLD for t in texts]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(filtered, docs.schema)
