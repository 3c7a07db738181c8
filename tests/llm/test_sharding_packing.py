import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F
from odd import SF_SMALL, odd_documents, odd_rows

from usagelens.llm import packing, sharding
from usagelens.llm.tokens import END_ID, WordTokenizer


def size(text):
    return len((text or "").encode()) + 1


def brute_shards(rows, shards):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode()), size(r[1])))
    total, at, out, seen = sum(size(r[1]) for r in rows), 0, [], defaultdict(int)
    for r in rows:
        n = size(r[1])
        shard = (2 * at + n) * shards // (2 * total)
        out.append((r[0], n, zlib.crc32((r[1] or "").encode()), shard, seen[shard]))
        seen[shard] += 1
        at += n
    return sorted(out, key=repr)


def found(frame):
    return sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in frame.collect()), key=repr)


def test_shards_equal_brute_force(spark):
    rows = odd_rows()
    for shards in (1, 3, 16):
        assert found(sharding.byte_shards(odd_documents(spark), shards, keys_per_task=3)) == brute_shards(rows, shards)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = sharding.byte_shards(docs)
    assert found(got) == brute_shards([(r.doc_id, r.text) for r in docs.collect()], 16)
    assert {r.law for r in got.collect()} == {"bytes"}


def test_shards_of_hot_and_empty_tables(spark):
    hot = [odd_rows()[9]] * 50 + odd_rows()
    assert found(sharding.byte_shards(odd_documents(spark, hot))) == brute_shards(hot, 16)
    assert sharding.byte_shards(odd_documents(spark, [])).count() == 0


def check_packing(frame, rows, capacity):
    tok = WordTokenizer()
    want = sorted(([*tok.t.encode(r[1] or "", add_special_tokens=False).ids, END_ID] for r in rows))
    pieces, taken = frame.collect(), defaultdict(list)
    for p in pieces:
        taken[p.sequence_id].append((p.offset, p.length))
    for parts in taken.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
    ids = {r[0]: [*tok.t.encode(r[1] or "", add_special_tokens=False).ids, END_ID] for r in rows}
    for doc_id, parts in by_doc.items():
        if sum(r[0] == doc_id for r in rows) > 1 or doc_id is None:
            continue
        at = 0
        for p in sorted(parts, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids[doc_id])
            cut = np.array(ids[doc_id][at:at + p.length], "<u4")
            assert p.ids_crc32 == zlib.crc32(cut.tobytes())
            at += p.length
        assert at == len(ids[doc_id])
    assert sum(p.length for p in pieces) == sum(map(len, want))
    return len(taken)


def test_packing_covers_every_id_once(spark):
    assert check_packing(packing.pack_documents(odd_documents(spark), 64, group_size=5), odd_rows(), 64) > 0
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    n = check_packing(packing.pack_documents(docs), rows, 4096)
    total = packing.pack_documents(docs).groupBy().sum("length").first()[0]
    assert total / (n * 4096) > 0.97
    assert packing.pack_documents(odd_documents(spark, [])).count() == 0


def test_tree_is_first_fit_decreasing():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 7, 300):
        lengths = np.sort(rng.integers(1, 101, n))[::-1]
        room, want = [], []
        for x in lengths.tolist():
            k = next((k for k, r in enumerate(room) if r >= x), len(room))
            if k == len(room):
                room.append(100)
            want.append((k, 100 - room[k]))
            room[k] -= x
        bins, offsets = packing.first_fit_decreasing(lengths, 100)
        assert list(zip(bins.tolist(), offsets.tolist())) == want


def test_tokenizer_cache_equals_the_library():
    tok = WordTokenizer(limit=5)
    texts = [r[1] or "" for r in odd_rows()] + ["'s't're", "A\x0bB\x0cC\x85D", "x<|startoftext|>y", "ÀÉß×÷ªº µ", "é İ ΑΣ", "1a2b_3"]
    for t in texts:
        assert tok.ids(t).tolist() == tok.t.encode(t, add_special_tokens=False).ids


def test_forms_of_a_word_share_one_cache_entry():
    tok, made = WordTokenizer(), []
    for cache in [v for v in vars(tok).values() if hasattr(v, "make")]:
        cache.make = (lambda make: lambda w: made.append(w) or make(w))(cache.make)
    words = [a + b + c for a in "bdfg" for b in "aeiou" for c in "klmn"]
    text = " ".join(f"{w} {w.upper()}. {w}, {w.capitalize()}!" for w in words)
    assert tok.ids(text).tolist() == tok.t.encode(text, add_special_tokens=False).ids
    assert len(made) <= len(words) + 3


def test_any_mix_of_pieces_equals_the_library():
    rng, tok = np.random.default_rng(3), WordTokenizer(limit=20)
    chars = list("aabzZ09.,'&-_ \n\t") + ["'s", "'ll", "é", "ÀB", "×", "ÿ", "\xa0", "\x85", "\u3000", "\x01", "\x7f", "Σ", "İ", "日本", "😀", "e\u0301"]
    for _ in range(3000):
        text = "".join(rng.choice(chars, rng.integers(0, 25)))
        assert tok.ids(text).tolist() == tok.t.encode(text, add_special_tokens=False).ids, repr(text)


def test_copies_of_one_key_are_unfolded_by_many_tasks(spark, monkeypatch):
    from odd import doc

    from usagelens.llm import common, mixing

    monkeypatch.setattr(common, "COPIES_PER_ROW", 16, raising=False)
    docs = odd_documents(spark, [doc(None, "a b c")] * 1000)
    shards = sharding.byte_shards(docs)
    for frame in (shards, mixing.mix(docs)):
        each = [r["count"] for r in frame.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(each) == 1000 and max(each) <= 700
    got = sorted((r.shard, r.slot) for r in shards.collect())
    assert len(set(got)) == 1000 and all(s == (k and got[k - 1][0] == h) * (got[k - 1][1] + 1) for k, (h, s) in enumerate(got))
