import math
import zlib
from fractions import Fraction

import numpy as np
import pytest
from odd import SF_SMALL, odd_documents
from pyspark.sql import functions as F

from usagelens.llm import tokenfile as tf
from usagelens.llm import topk
from usagelens.llm.tokens import END_ID, WordTokenizer
from usagelens.session import scratch_path


@pytest.mark.parametrize("n, lanes, every", [(1, 1, 1), (5, 4, 1), (1000, 16, 7), (5000, 64, 1000)])
def test_coder_round_trip(n, lanes, every):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n), 999).astype(np.uint32)
    table = tf.Frequencies(tf.scale_counts(np.bincount(ids, minlength=1000)))
    data = tf.encode_block([(3, ids[: n // 2]), (None, ids[n // 2:])], table, lanes, every)
    block = tf.Block(data, table)
    assert block.ids().tolist() == ids.tolist() and block.doc_ids == [3, None]
    k = len(block.marks) - 1  # the last checkpoint alone
    assert block.decode_segment(k).tolist() == ids[block.marks[k][0] * block.lanes:].tolist()
    for at in (10, len(data) // 2, len(data) - 1):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            tf.Block(bytes(broken), table).ids()


def test_frequencies_sum_and_cover():
    for counts in ([0, 0, 0], [1, 0, 10 ** 12], [5] * 49408):
        f = tf.scale_counts(np.array(counts, np.int64))
        assert f.sum() == 1 << tf.PRECISION and f.min() >= 1


def want_tokens(rows):
    tok, at, out = WordTokenizer(), 0, []
    for doc_id, ids in sorted(((r[0], [*tok.t.encode(r[1] or "", add_special_tokens=False).ids, END_ID]) for r in rows),
                              key=lambda x: (x[0] is not None, x[0] or 0)):
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_files_hold_every_text_in_order(spark):
    for docs in (spark.read.parquet(f"{SF_SMALL}/documents.parquet"), odd_documents(spark)):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        path = tf.write_token_files(docs, scratch_path(spark, "t"), block_ids=3000)
        got = tf.read_token_files(spark, path, with_ids=True).collect()
        want = want_tokens(rows)
        assert sorted((r.start for r in got)) != [] and sum(r.n_tokens for r in got) == sum(w[2] for w in want)
        unique = [w for w in want if sum(r[0] == w[0] for r in rows) == 1 and w[0] is not None]
        found = {r.doc_id: (r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got}
        assert [found[w[0]] for w in unique] == unique
        assert sorted((r.n_tokens, r.ids_crc32) for r in got) == sorted(w[2:] for w in want)
        for r in got:
            assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    assert tf.token_digests(odd_documents(spark, [])).count() == 0


def brute_top_k(rows, k):
    good = [(i, [math.floor(Fraction(x) * 256) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, (i, v) in enumerate(good):
        if i % 50:
            continue
        s = sorted((-max(-2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(v, w)))), j) for j, w in good
                   if j != i and len(w) == len(v))
        out += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s[:k])]
    return sorted(out)


def run_top_k(spark, rows, k, kind="double"):
    df = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>").withColumn("no", F.lit(1)).withColumn("id", F.lit(2))
    got = topk.top_k(df.repartition(3), F.col("id") % 50 == 0, k)
    return sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect())


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 1, 4).tolist()) for i in range(120)]
    rows += [(200 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(60)]  # ties
    rows += [(500, None), (550, [1.0, None, 1.0, 1.0]), (600, [math.nan] * 4), (650, [math.inf] * 4), (None, [1.0] * 4),
             (700, []), (701, []), (750, [1.0, 2.0]), (751, [3.0, 4.0]), (800, [9.0] * 3), (100, [0.1] * 4), (7, [0.2] * 4)]
    assert run_top_k(spark, rows, 5) == brute_top_k(rows, 5)


def test_top_k_of_huge_values_few_rows_and_none(spark):
    rows = [(0, [1e300, -1e300]), (1, [1e300, 1e10]), (2, [-1e300, 5.0]), (3, [1e18, 2e18])]
    assert run_top_k(spark, rows, 5) == brute_top_k(rows, 5)
    assert run_top_k(spark, [], 5) == [] and run_top_k(spark, [(1, [1.0])], 5) == []


def test_top_k_in_several_query_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK_ROWS", 2)
    rows = [(i * 10, [float(i % 7), float(i % 5)]) for i in range(40)]
    assert run_top_k(spark, rows, 3) == brute_top_k(rows, 3)
