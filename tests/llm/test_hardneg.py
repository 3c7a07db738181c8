import math
from fractions import Fraction

import numpy as np
from odd import SF_SMALL
from pyspark.sql import functions as F

from usagelens.llm import hardneg

SCHEMA = "vec_id long, label int, embedding array<float>, score double, no long, part int, row long, dim int"


def brute(rows, every, positives=5, negatives=5):
    live = [(i, la, [math.floor(Fraction(x) * 256) for x in v]) for i, la, v in rows
            if i is not None and la is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, la, v in live:
        if i % every:
            continue
        near = [(max(-1 << 63, min((1 << 63) - 1, sum(a * b for a, b in zip(v, w)))), j, lb)
                for j, lb, w in live if j != i and len(w) == len(v)]
        near.sort(key=lambda s: (-s[0], s[1]))
        for ps, j, _ in [s for s in near if s[2] == la][:positives]:
            fit = [s for s in near if s[2] != la and 80 * ps <= 100 * s[0] <= 100 * ps][:negatives]
            out += [(i, j, r, s[1], ps, s[0]) for r, s in enumerate(fit, 1)]
    return sorted(out)


def found(spark, rows, every, **more):
    frame = spark.createDataFrame([(*r, 0.5, 1, 1, 1, 1) for r in rows], SCHEMA).repartition(3)
    got = hardneg.hard_negatives(frame, F.col("id") % every == 0, **more)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def floats(x):
    return [float(np.float32(v)) for v in x]


def test_odd_tables(spark):
    r = np.random.default_rng(1)
    rows = [(i, int(r.integers(3)), floats(r.normal(size=4))) for i in range(60)]
    rows += [(i, i % 2, floats([1, 1, 1, 1])) for i in range(60, 90)]  # ties
    rows += [(20, 0, floats([1, 1, 1, 1]))] * 4 + [(21, 1, floats([1, 1, 1, 1]))] * 9  # repeated rows and ids
    rows += [(20, 1, floats([0.9, 1, 1, 1]))]
    rows += [(100 + i, i % 3, floats(r.normal(size=2))) for i in range(12)]  # another length
    rows += [(200, 0, []), (210, 1, []), (220, 0, []), (-10, 1, floats([1, 2, 1, 1]))]
    rows += [(300, None, floats([1, 1, 1, 1])), (None, 1, floats([1, 1, 1, 1])), (310, 1, None), (320, 1, [1.0, None, 1.0, 1.0]),
             (330, 1, [1.0, math.inf, 1.0, 1.0]), (340, 1, [1.0, math.nan, 1.0, 1.0])]
    want = brute(rows, 10)
    assert len(want) > 50
    assert found(spark, rows, 10) == want
    assert found(spark, rows, 10, tree_rows=2, candidate_bytes=400, anchor_bytes=200) == want
    assert found(spark, rows, 10, positives=2, negatives=1) == brute(rows, 10, 2, 1)


def test_very_large_numbers(spark):
    rows = [(i, i % 2, floats([10.0 ** (3 * i - 10), 1, -2])) for i in range(16)]
    assert found(spark, rows, 2) == brute(rows, 2)


def test_empty_and_single(spark):
    assert found(spark, [], 10) == [] and found(spark, [(10, 1, [1.0])], 10) == []
    assert found(spark, [(10, 1, [1.0]), (11, 1, [1.0])], 10) == []


def test_given_table_and_small_tiles(spark):
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = [(r.vec_id, r.label, r.embedding) for r in table.collect()]
    got = hardneg.hard_negatives(table, F.col("id") % 5 == 0, tree_rows=8, candidate_bytes=20000, anchor_bytes=4000)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5)


def test_trees_span_with_least_length():
    points = np.random.default_rng(3).normal(size=(40, 3))
    order, parent, edge = hardneg.spanning_tree(points)
    assert sorted(order) == list(range(40)) and parent[0] == -1 and all(p < i for i, p in enumerate(parent))
    assert all(abs(np.linalg.norm(points[order[i]] - points[order[p]]) - e) < 1e-9
               for i, (p, e) in enumerate(zip(parent, edge)) if i)
    pairs = sorted((np.linalg.norm(points[i] - points[j]), i, j) for i in range(40) for j in range(i))
    root, total = list(range(40)), 0.0  # Kruskal
    for d, i, j in pairs:
        if root[i] != root[j]:
            total += d
            root = [root[j] if x == root[i] else x for x in root]
    assert abs(total - sum(edge)) < 1e-9
    assert hardneg.spanning_tree(np.ones((3, 2)))[2] == [0.0, 0.0, 0.0]


def test_bounds_spare_most_scores_of_close_anchors():
    r = np.random.default_rng(4)
    centres = r.normal(size=(20, 32)) * 300
    candidates = np.floor(centres[r.integers(20, size=4000)] + r.normal(size=(4000, 32)) * 10)
    points = np.floor(centres[0] + r.normal(size=(30, 32)) * 10)
    order, parent, edge = hardneg.spanning_tree(points)
    points, ids = points[order], np.arange(4000)
    best = [np.sort(candidates @ p)[::-1] for p in points]
    wants = [hardneg._Want(hardneg.windows_of([int(b[10])], 80, 100), 5) for b in best]
    count = hardneg.walk(points, parent, edge, [-1] * 30, wants, candidates, ids)
    assert count < 4000 * 30 / 3
    for p, b, w in zip(points, best, wants):
        s = candidates @ p
        fit = sorted((-x, i) for i, x in enumerate(s) if -(-80 * int(b[10]) // 100) <= x <= b[10])[:5]
        assert [(-int(x), int(i)) for x, i in zip(*w.best[0])] == fit
