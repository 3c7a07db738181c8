"""Byte-level BPE of whole texts, merged by a segment tree over adjacent pairs.

A text is cut at added tokens and by the vocabulary's split pattern. A piece starts as the
ids of its bytes. A segment tree holds a key, rank then place, for each pair of neighbours
that the vocabulary merges, and the root holds the least key: the leftmost of the pairs of
the lowest rank. That pair is merged, and three leaves change: its own, the swallowed
symbol's and the one to the left. A change climbs until a node keeps its value. The piece is
done when the root holds no mergeable pair. A piece of n bytes so takes O(n log n) steps,
also where it is one long run of the same character.

Ids and decoded texts equal those of the tokenizers library for such a vocabulary file
(byte_bpe_50k.json). Where a stretch of text has only letters, decimal digits, marks, signs and
common blanks, Python's re applies the split pattern, as its classes are then the library's;
a stretch with any other character (further numbers, separators U+001C to U+001F, characters that
Unicode 15.1 has not assigned) is split by the library. A worker keeps the ids of short pieces in
a cache of bounded size. Long texts are cut into stretches of about a million characters, at a
blank between two other characters, where no piece of the pattern continues.

Cases: a null text is encoded as the empty text and has no ids; an empty table gives no rows; an
added token's string in a text is that token; ids outside of the vocabulary decode to nothing, as in
the library; bytes that are no UTF-8 decode to U+FFFD; no rows are dropped or merged.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from usagelens.llm.common import ship
from usagelens.llm.tokens import vocabulary_path

VOCABULARY = "byte_bpe_50k.json"
STRETCH = 1 << 20
IDS_AT_ONCE = 1 << 20
ROWS_AT_ONCE = 256
_CUT = re.compile(r"(?<=\S) (?=\S)")
# The vocabulary's split pattern (a fixed value) in classes of Python's re: letters, decimal
# digits, other marks, blanks at the end or before a word.
_SPLIT = re.compile(r" ?[^\W\d_]+|'(?:s|t|re|ve|m|ll|d)| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+").findall


def merge(ids: list[int], ranks: dict[int, int], merged: list[int], size: int) -> list[int]:
    """The symbols of one piece after all merges. ``ranks`` has the rank of a pair (a, b) at
    ``a * size + b``, ``merged`` the new symbol of a rank."""
    n = len(ids)
    pairs = n - 1
    if pairs < 1:
        return ids
    none = len(merged) * n  # above every key
    keys = [(ranks[p] * n + i if (p := ids[i] * size + ids[i + 1]) in ranks else none) for i in range(pairs)]
    tree = [none] * pairs + keys
    for i in range(pairs - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b

    def change(i: int, key: int) -> None:
        i += pairs
        tree[i] = key
        while i > 1:
            other = tree[i ^ 1]
            if other < key:
                key = other
            i >>= 1
            if tree[i] == key:
                return
            tree[i] = key

    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while (least := tree[1]) < none:
        rank, i = divmod(least, n)
        j = after[i]
        k = after[j]
        new = ids[i] = merged[rank]
        ids[j] = -1
        after[i] = k
        if j < pairs:
            change(j, none)
        if k < n:
            before[k] = i
            rank = ranks.get(new * size + ids[k])
            change(i, none if rank is None else rank * n + i)
        else:
            change(i, none)
        h = before[i]
        if h >= 0:
            rank = ranks.get(ids[h] * size + new)
            change(h, none if rank is None else rank * n + h)
    return [x for x in ids if x >= 0]


class _Cache(dict):
    """Piece -> its ids as 4-byte integers, for the first ``limit`` short pieces met; others are
    encoded each time."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, piece: str) -> bytes:
        got = self.make(piece)
        if len(piece) <= 64 and len(self) < self.limit:
            self[piece] = got
        return got


class _Plain(dict):
    """Character -> whether the classes of _SPLIT are the vocabulary's for it."""

    def __missing__(self, c: str) -> bool:
        kind = unicodedata.category(c)
        got = self[c] = kind not in ("Cn", "Nl", "No") and c not in "\x1c\x1d\x1e\x1f"
        return got


class Codec:
    """Encoder and decoder of one vocabulary file, with a cache of at most ``limit`` short pieces."""

    def __init__(self, name: str = VOCABULARY, limit: int = 300_000):
        from tokenizers.pre_tokenizers import ByteLevel

        with open(vocabulary_path(name), encoding="utf-8") as f:
            spec = json.load(f)
        model, added = spec["model"], spec["added_tokens"]
        if model["type"] != "BPE" or spec["pre_tokenizer"].get("type") != "ByteLevel" or spec["normalizer"] or any(
                t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError(f"{name} is no plain byte-level BPE vocabulary")
        vocab = model["vocab"]
        self.library_split = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
        self.plain = _Plain()
        self.added = {t["content"]: t["id"] for t in added}
        self.added_split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.size = 1 + max(*vocab.values(), *self.added.values())

        letters = _byte_letters()
        self.first = [vocab[letters[b]] for b in range(256)]
        self.ranks, self.merged = {}, []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks.setdefault(vocab[a] * self.size + vocab[b], rank)
            self.merged.append(vocab[a + b])
        byte_of = {c: b for b, c in enumerate(letters)}
        self.bytes = [b""] * self.size
        for token, i in vocab.items():
            self.bytes[i] = bytes(byte_of[c] for c in token)
        for token, i in self.added.items():
            self.bytes[i] = token.encode()
        self.decimal = [str(i) for i in range(self.size)]
        self.cache = _Cache(self.piece, limit)

    def piece(self, piece: str) -> bytes:
        """Ids of one piece of the pattern."""
        return array("i", merge([self.first[b] for b in piece.encode()], self.ranks, self.merged, self.size)).tobytes()

    def pieces(self, stretch: str) -> list[str]:
        if stretch.isascii() and stretch.isprintable() or all(map(self.plain.__getitem__, set(stretch))):
            return _SPLIT(stretch)
        return [stretch[a:b] for _, (a, b) in self.library_split(stretch)]

    def encode(self, text: str) -> array:
        ids = array("i")
        for part in self.added_split.split(text):
            if part in self.added:
                ids.append(self.added[part])
                continue
            for stretch in stretches(part):
                ids.frombytes(b"".join(map(self.cache.__getitem__, self.pieces(stretch))))
        return ids

    def text(self, ids) -> Iterator[str]:
        """The decoded text in parts."""
        known = codecs.getincrementaldecoder("utf-8")(errors="replace")
        table, size = self.bytes, self.size
        for at in range(0, len(ids), IDS_AT_ONCE):
            yield known.decode(b"".join([table[i] for i in ids[at:at + IDS_AT_ONCE] if 0 <= i < size]))
        yield known.decode(b"", True)

    def decode(self, ids) -> str:
        return "".join(self.text(ids))

    def digests(self, text: str) -> tuple[int, str, str]:
        """(number of ids, SHA-256 of the decimal ids joined by commas, of the decoded text)."""
        ids = self.encode(text)
        listed, decoded = hashlib.sha256(), hashlib.sha256()
        for at in range(0, len(ids), IDS_AT_ONCE):
            part = ",".join(map(self.decimal.__getitem__, ids[at:at + IDS_AT_ONCE]))
            listed.update((("," if at else "") + part).encode())
        for part in self.text(ids):
            decoded.update(part.encode())
        return len(ids), listed.hexdigest(), decoded.hexdigest()


def _byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable bytes for
    themselves, the others for the characters from U+0100 on, in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def stretches(text: str, length: int = STRETCH) -> Iterator[str]:
    """``text`` cut after about ``length`` characters each, where no piece is cut."""
    at = 0
    while len(text) - at > length:
        cut = _CUT.search(text, at + length)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


_MADE: dict[str, Codec] = {}


def codec(name: str = VOCABULARY) -> Codec:
    """One codec per Python worker and vocabulary."""
    if name not in _MADE:
        _MADE[name] = Codec(name)
    return _MADE[name]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def _with_column(df: DataFrame, source: str, out: str, kind, arrow_kind: pa.DataType, make) -> DataFrame:
    """``df`` with ``out`` (replaced if it is there already) made from each value of ``source``."""
    ship(df.sparkSession)
    kept = [c for c in df.columns if c != out]
    rows = df.select(*kept, F.col(source).alias("__from"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            made = pa.array([make(v) for v in part.column("__from").to_pylist()], arrow_kind)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], made], names=[*kept, out])

    return rows.mapInArrow(run, StructType([*(rows.schema[c] for c in kept), StructField(out, kind)]))


def encode(docs: DataFrame, text: str = "text", ids: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with the column ``ids`` (array of int) of each whole text."""
    return _with_column(docs, text, ids, ArrayType(IntegerType()), pa.list_(pa.int32()),
                        lambda t: codec(vocabulary).encode(t or ""))


def decode(encoded: DataFrame, ids: str = "ids", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``encoded`` with the column ``text`` of each row's ids (null ids: empty; null elements: nothing)."""
    return _with_column(encoded, ids, text, StringType(), pa.string(),
                        lambda v: codec(vocabulary).decode([i for i in v or [] if i is not None]))


def round_trip_digests(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: each text encoded, and its ids decoded, in
    one pass; one row per input row, no shuffle."""
    ship(docs.sparkSession)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            made = [codec(vocabulary).digests(t or "") for t in part.column(1).to_pylist()]
            n, ids, texts = zip(*made) if made else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
