import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import xxhash
from odd import PROSE, SF_SMALL, odd_documents, odd_rows
from pyspark.sql import functions as F

from usagelens.llm import imatch, quality, termclasses

M64 = (1 << 64) - 1


def test_scores_tell_held_out_quality(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality.score(docs, quality.train(docs, labels))
    rows = got.join(labels, "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.9
    assert all(r.predicted for r in held if r.quality)  # clean documents stay
    assert got.count() == docs.count()


def test_training_never_sees_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - quality, quality) AS quality", "toxic")
    a, b = quality.train(docs, labels), quality.train(docs, flipped)
    assert np.array_equal(a.product, b.product) and (a.slope, a.offset) == (b.slope, b.offset)


def test_quality_of_odd_rows_and_without_labels(spark):
    schema = "doc_id bigint, quality int, toxic int"
    docs = odd_documents(spark)
    none = quality.train(docs, spark.createDataFrame([], schema))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    one = quality.train(docs, spark.createDataFrame([(i, 1, 0) for i in range(20)], schema))
    assert all(r.predicted == 1 for r in quality.score(docs, one).collect())
    labels = spark.createDataFrame([(i, int(i in (4, 5, 13)), 0) for i in range(20)] + [(4, None, 0), (None, 1, 0)], schema)
    model = quality.train(docs, labels)
    got = quality.score(docs, model).collect()
    assert len(got) == len(odd_rows()) and all(np.isfinite(r.score) for r in got)
    kept = quality.keep_good(docs, model)
    assert kept.schema.simpleString() == docs.schema.simpleString()
    assert kept.count() == sum(r.predicted for r in got)
    assert quality.score(odd_documents(spark, []), model).count() == 0


def test_dual_coordinate_descent_reaches_the_optimum(monkeypatch):
    """The gradient of the primal vanishes: w = 2C sum max(0, 1 - y w.x) y x."""
    monkeypatch.setattr(quality, "INTERPOLATION", 1.0)
    rng = np.random.default_rng(2)
    rows = [np.unique(rng.integers(0, 40, 6)).astype(np.int32) for _ in range(60)]
    good = rng.integers(0, 2, 60)
    scale = np.zeros(quality.FEATURES)
    scale[:40] = rng.normal(0, 1, 40)
    w = quality.dual_coordinate_descent(rows, scale, good, epochs=3000)
    want = np.zeros_like(w)
    for at, y in zip(rows, np.where(good > 0, 1, -1)):
        x = scale[at] / np.sqrt((scale[at] ** 2).sum())
        want[at] += 2 * max(0.0, 1 - y * (w[at] @ x)) * y * x
    assert np.abs(w - want).max() < 1e-6


def brute_edits(rows):
    """By descending doc_id; only for distinct ids."""
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        out[i] = (len(text), hashlib.sha256((text[:len(text) - half] + after[:half]).encode()).hexdigest())
    return out


def test_edits_and_likeness(spark, monkeypatch):
    monkeypatch.setattr(imatch, "DOCS_PER_TASK", 7)  # many runs: neighbours across their ends
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = imatch.fingerprints(docs).collect()
    want = brute_edits([(r.doc_id, r.text or "") for r in docs.collect()])
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == want
    texts = {r.doc_id: r.text for r in docs.collect()}
    by_text = {}
    for r in got:
        assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
        a, b = (np.frombuffer(bytes.fromhex(x), np.uint8) for x in (r.fingerprint, r.edited_fingerprint))
        assert r.near_edited == imatch.likeness(a, b) and 0 <= r.near_next <= 1
    assert sum(r.near_edited >= r.near_next for r in got) / len(got) > 0.95
    assert np.mean([r.near_edited for r in got]) > 5 * np.mean([r.near_next for r in got])


def test_fingerprints_of_odd_rows(spark):
    got = imatch.fingerprints(odd_documents(spark)).collect()
    assert len(got) == len(odd_rows())
    unique = [(r[0], r[1] or "") for r in odd_rows() if r[0] is not None and r[0] != 8]
    found = {r.doc_id: r for r in got}
    for i, text in unique:
        assert found[i].n_chars == len(text)
    same = {r.fingerprint for r in got if r.doc_id in (7, 8)}
    assert len(same) == 1
    one = imatch.fingerprints(odd_documents(spark, [odd_rows()[8]])).collect()
    half = len(PROSE) // 2
    assert one[0].edited_sha256 == hashlib.sha256((PROSE[:len(PROSE) - half] + PROSE[:half]).encode()).hexdigest()
    assert one[0].near_next == 1.0
    assert imatch.fingerprints(odd_documents(spark, [])).count() == 0


def band_by_hand(texts, low=imatch.MIN_IDF, high=imatch.MAX_IDF):
    words = Counter(w for t in texts for w in set(t.encode().lower().split()))
    return {w for w, n in words.items() if low <= math.log(len(texts) / n) <= high}


def scramble(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & M64
    x = (x ^ x >> 27) * 0x94D049BB133111EB & M64
    return x ^ x >> 31


def fingerprint_by_hand(text, band):
    """I-Match word by word, in plain integers."""
    words = set(text.encode().lower().split())
    kept = words & band
    hashes = sorted(xxhash.xxh64_intdigest(w, 7) for w in (kept if len(kept) >= 4 else words))
    out = []
    for rung, bits in enumerate((4, 6, 8, 10, 12, 14), 1):
        lists = {}
        for h in hashes:
            dealt = scramble(h ^ scramble(rung * 0x9E3779B97F4A7C15 & M64))
            lists.setdefault(dealt >> 64 - bits, []).append(dealt)
        for cell in range(min(32, 1 << bits)):
            marks = [scramble(d + place & M64) for place, d in enumerate(lists.get(cell, []))]
            out.append(scramble(sum(marks) & M64) % 255 + 1 if marks else 0)
    return bytes(out).hex()


def test_document_frequencies_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(imatch, "TERMS_HELD", 5)
    got = {r.term: r.n for r in imatch.document_frequencies(odd_documents(spark)).collect()}
    words = Counter(w for r in odd_rows() for w in set((r[1] or "").encode().lower().split()))
    assert got == {np.uint64(xxhash.xxh64_intdigest(w, 7)).astype(np.int64): n for w, n in words.items()}


def test_class_frequencies_equal_brute_force(spark):
    rows = odd_rows()
    total, n = termclasses.class_frequencies(odd_documents(spark))
    want = np.zeros_like(total)
    for r in rows:
        want[np.unique(termclasses.slots(imatch.terms(r[1] or "")))] += 1
    assert n == len(rows) and np.array_equal(total, want)


def test_fingerprints_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = docs.collect()
    band = band_by_hand([r.text or "" for r in rows])
    assert 100 < len(band)
    want = {r.doc_id: fingerprint_by_hand(r.text or "", band) for r in rows}
    assert {r.doc_id: r.fingerprint for r in imatch.fingerprints(docs).collect()} == want


def test_rare_and_common_terms_are_outside_the_band(spark):
    """e^9 is 8103: in 10,000 documents a term of one document is rare, of two it is not."""
    n = 10000
    text = F.concat_ws(" ", F.lit("common"), F.concat(F.lit("once"), "doc_id"),
                       F.concat(F.lit("pair"), F.floor(F.col("doc_id") / 2)),
                       *[F.concat(F.lit(f"g{k}x"), F.floor(F.col("doc_id") / (40 + k))) for k in range(6)])
    docs = spark.range(n).select(F.col("id").alias("doc_id")).withColumn("text", text)
    words = imatch.lexicon(docs)
    texts = [r.text for r in docs.collect()]
    band = band_by_hand(texts)
    assert set(words.tolist()) == {xxhash.xxh64_intdigest(w, 7) for w in band}
    assert not any(w.startswith((b"once", b"common")) for w in band) and any(w.startswith(b"pair") for w in band)
    a, b = texts[0], texts[0].replace("once0", "once-other")
    assert np.array_equal(imatch.fingerprint(a, words), imatch.fingerprint(b, words))
    assert not np.array_equal(imatch.fingerprint(a, words), imatch.fingerprint(a.replace("pair0", "pair7"), words))
    # No room for the pairs: the upper edge comes down until the band fits.
    few = imatch.lexicon(docs, most=3000)
    assert 0 < len(few) <= 3000 and set(few) < set(words)
    assert set(few.tolist()) == {xxhash.xxh64_intdigest(w, 7) for w in band if not w.startswith(b"pair")}


def test_place_keys_sort_as_triples():
    import random

    r = random.Random(1)
    edge = [-(1 << 63), -1, 0, 1, 255, 256, (1 << 63) - 1]
    rows = [(r.random() < 0.3, r.choice(edge), r.choice(edge)) for _ in range(400)]
    rows += [(False, r.randrange(-1 << 63, 1 << 63), r.randrange(-1 << 63, 1 << 63)) for _ in range(400)]
    keys = imatch.place_keys(*zip(*rows))
    assert [rows[i] for i in np.argsort(keys, kind="stable")] == sorted(rows)
    assert [bool(a == b) for a, b in zip(keys, keys[1:])] == [a == b for a, b in zip(rows, rows[1:])]


def test_runs_are_not_part_of_the_plan(spark, monkeypatch):
    import re

    def plan_and_rows():
        frame = imatch.fingerprints(odd_documents(spark))
        text = re.sub(r"\d+|file:\S+|/\S+", "", frame._jdf.queryExecution().optimizedPlan().toString())
        return len(text), sorted(map(repr, frame.collect()))

    monkeypatch.setattr(imatch, "DOCS_PER_TASK", 5)
    few = plan_and_rows()
    monkeypatch.setattr(imatch, "DOCS_PER_TASK", 1)
    assert plan_and_rows() == few
