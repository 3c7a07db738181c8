import hashlib
import random
import unicodedata

import pytest
from odd import PROSE, SF_SMALL, doc, odd_documents, odd_rows
from tokenizers import Tokenizer

from usagelens.llm import bpe
from usagelens.llm.tokens import vocabulary_path


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path(bpe.VOCABULARY))


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec()


def same(codec, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    got = codec.encode(text)
    assert list(got) == ids, text[:80]
    assert codec.decode(got) == library.decode(ids, skip_special_tokens=False)


def slow_merge(ids, codec):
    """The leftmost pair of the lowest rank, found by looking at all of them."""
    ids = list(ids)
    while True:
        found = [(codec.ranks[a * codec.size + b], i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if a * codec.size + b in codec.ranks]
        if not found:
            return ids
        rank, i = min(found)
        ids[i:i + 2] = [codec.merged[rank]]


def test_merge_equals_a_full_search(codec):
    r = random.Random(5)
    for n in [*range(40)] * 5:
        first = [codec.first[b] for b in "".join(r.choice("aabething ") for _ in range(n)).encode()]
        assert bpe.merge(list(first), codec.ranks, codec.merged, codec.size) == slow_merge(first, codec)


def test_random_texts_equal_the_library(codec, library):
    r = random.Random(3)
    letters = [c for c in map(chr, range(0x3000)) if unicodedata.category(c) != "Cs"]
    odd = ["'s", "'re", "<|endoftext|>", "\x1c", "\x85", "　", "  ", "\n\n", "²", "½", "٣", "𝟘", "😀", "\U0001e6c0", "՘", "Ⅷ"]
    for k in range(3000):
        pool = letters if k % 3 == 0 else [*"abcde tion.,'0123 "] if k % 3 == 1 else [*odd, *"ab 1'"]
        same(codec, library, "".join(r.choice(pool) for _ in range(r.randrange(60))))


def test_every_character_is_cut_as_by_the_library(codec):
    for c in range(0x110000):
        if c % 5 == 0 and not 0xD800 <= c < 0xE000 or c < 0x600:
            s = "a" + chr(c) + "1" + chr(c) + " " + chr(c) * 2 + "!" + chr(c) + "  x"
            assert codec.pieces(s) == [s[a:b] for _, (a, b) in codec.library_split(s)], hex(c)


def test_long_runs_and_stretches(codec, library):
    for text in ("a" * 20000, "ab" * 9000 + " ", "é日" * 5000, " " * 9999, PROSE * 300, ("x" * 50 + "  y\n") * 400):
        same(codec, library, text)
        parts = list(bpe.stretches(text, 100))
        assert "".join(parts) == text
        assert [p for s in parts for p in codec.pieces(s)] == list(codec.pieces(text))


def test_decoding_any_ids_equals_the_library(codec, library):
    r = random.Random(2)
    for _ in range(500):
        ids = [r.randrange(256) if r.random() < 0.6 else r.randrange(codec.size) for _ in range(r.randrange(25))]
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)
    assert codec.decode([-1, codec.size, codec.first[65]]) == "A"


def brute(rows, library):
    out = []
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        texts = ",".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)
        out.append((r[0], len(ids), *(hashlib.sha256(t.encode()).hexdigest() for t in texts)))
    return sorted(out, key=repr)


def test_digests_of_documents(spark, library):
    assert sorted((tuple(r) for r in bpe.round_trip_digests(odd_documents(spark)).collect()), key=repr) == brute(odd_rows(), library)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((tuple(r) for r in bpe.round_trip_digests(docs).collect()), key=repr) == brute(rows, library)
    assert bpe.round_trip_digests(odd_documents(spark, [])).count() == 0


def test_ids_and_texts_as_columns(spark, library):
    docs = odd_documents(spark, [*odd_rows(), doc(99, "two <|endoftext|> parts")])
    coded = bpe.encode(docs)
    assert coded.columns == [*docs.columns, "ids"]
    back = bpe.decode(coded, text="again").collect()
    assert len(back) == len(odd_rows()) + 1
    for r in back:
        assert list(r["ids"]) == library.encode(r["text"] or "", add_special_tokens=False).ids and r["again"] == (r["text"] or "")
    assert bpe.encode(docs, ids="row").columns == [*[c for c in docs.columns if c != "row"], "row"]
    assert bpe.decode(spark.createDataFrame([(None,), ([5, None],)], "ids array<int>")).count() == 2
