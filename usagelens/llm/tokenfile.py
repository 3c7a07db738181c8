"""Token files: a static range asymmetric numeral system (rANS) over shared frequencies.

Layout of a token folder, both parts Parquet so that Spark's commit protocol covers
lost executors and any store Spark reads can hold it:

* ``frequencies`` (id, freq): one row per id of the vocabulary, summing to 2^22. Every
  block is coded with this one table; ids that never occur keep frequency 1.
* ``blocks`` (part, block, first_id, n_docs, n_ids, data): ``data`` is an independent
  block of whole documents, at least BLOCK_IDS ids unless it ends a part, in ascending
  doc_id order (null first) over (part, block).

A block's bytes: the header (see ``_HEADER``), per document its id, a null flag and its
number of ids, then the coder's data. Id number i of a block belongs to lane i mod
lanes and step i div lanes; the lanes are coded side by side with 64-bit states that
give off 32-bit words. Every CHECKPOINT_STEPS steps, and at step 0, the block holds all
lane states and the place in the word stream, so ``decode_segment`` starts at any
checkpoint without decoding what stands before it. CRC-32 sums cover the ids, and
the header with everything behind it; a block that fails one raises ValueError.

Cases: a null or empty text is a document of one id, the end id; repeated rows are
repeated documents; a document is never split, so a block grows to hold a longer one;
an empty table gives empty files and an empty result; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from usagelens.llm.common import ship, stage, text_or_empty, width
from usagelens.llm.tokens import END_ID, VOCABULARY, tokenizer
from usagelens.session import scratch_path

PRECISION = 22
BLOCK_IDS = 1 << 18
LANES = 1024
CHECKPOINT_STEPS = 128
IDS_PER_PART = 1 << 24

_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_MASK = np.uint64((1 << PRECISION) - 1)
_SHIFT = np.uint64(PRECISION)
_SLOTS = np.uint64(1 << PRECISION)
_ROOM = np.uint64(63 - PRECISION)
_MAGIC = b"UTB1"
# magic, documents, ids, lanes, steps, words, checkpoints, crc of the frequencies, of the ids, of the rest
_HEADER = struct.Struct("<4sIQIIIIIII")


class Frequencies:
    """The shared table: frequency and first slot of each id."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.first = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.crc = zlib.crc32(freq.astype("<u4").tobytes())
        self._slots: np.ndarray | None = None

    @property
    def slots(self) -> np.ndarray:
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._slots


def scale_counts(counts: np.ndarray, total: int = 1 << PRECISION) -> np.ndarray:
    """Counts -> frequencies of at least 1 that sum to ``total``: each id gets 1, the rest
    is shared in proportion, and what rounding leaves goes to the most frequent ids."""
    spare = total - len(counts)
    if spare < 0:
        raise ValueError(f"{len(counts)} ids need more than {total} slots")
    seen = int(counts.sum())
    if seen == 0:
        counts, seen = np.ones_like(counts), len(counts)
    share = np.array([int(c) * spare // seen for c in counts.tolist()], np.int64)
    left = spare - int(share.sum())  # fewer than there are ids
    share[np.argsort(-counts, kind="stable")[:left]] += 1
    return share + 1


def encode_ids(ids: np.ndarray, table: Frequencies, lanes: int, every: int):
    """(words, checkpoints): checkpoints are (step, word position, lane states)."""
    n = len(ids)
    steps = -(-n // lanes)
    x = np.full(lanes, _LOW, np.uint64)
    out: list[np.ndarray] = [None] * steps
    states: dict[int, np.ndarray] = {}
    for t in range(steps - 1, -1, -1):
        step = ids[t * lanes:(t + 1) * lanes]
        f, s = table.freq[step], x[:len(step)]
        full = np.flatnonzero(s >= (f << _ROOM))
        moved = s[full]
        out[t] = moved.astype(np.uint32)
        s[full] = moved >> _WORD
        q = s // f
        s += q * (_SLOTS - f) + table.first[step]  # (q << PRECISION) + (s - q * f) + first
        if t % every == 0:
            states[t] = x.copy()
    before = np.concatenate([[0], np.cumsum([len(w) for w in out])])
    words = np.concatenate(out) if out else np.zeros(0, np.uint32)
    return words, [(t, int(before[t]), states[t]) for t in sorted(states)]


def encode_block(docs: list[tuple[int | None, np.ndarray]], table: Frequencies, lanes: int = LANES,
                 every: int = CHECKPOINT_STEPS) -> bytes:
    ids = np.concatenate([d for _, d in docs]).astype(np.int64)
    lanes = max(1, min(lanes, len(ids) // 64))
    words, marks = encode_ids(ids, table, lanes, every)
    body = b"".join([
        np.array([d or 0 for d, _ in docs], "<i8").tobytes(),
        np.array([d is None for d, _ in docs], "u1").tobytes(),
        np.array([len(x) for _, x in docs], "<u8").tobytes(),
        *[struct.pack("<II", t, at) + states.astype("<u8").tobytes() for t, at, states in marks],
        words.astype("<u4").tobytes()])
    fields = (_MAGIC, len(docs), len(ids), lanes, -(-len(ids) // lanes), len(words), len(marks), table.crc,
              zlib.crc32(ids.astype("<u4").tobytes()))
    return _HEADER.pack(*fields, zlib.crc32(body, zlib.crc32(_HEADER.pack(*fields, 0)))) + body


class Block:
    """A block's bytes, taken apart and checked."""

    def __init__(self, data: bytes, table: Frequencies):
        (magic, n, self.n_ids, self.lanes, self.steps, words, marks, freq_crc, self.ids_crc,
         body_crc) = _HEADER.unpack_from(data)
        if magic != _MAGIC or freq_crc != table.crc:
            raise ValueError("not a block of this frequency table")
        head = data[:_HEADER.size - 4] + bytes(4)  # the last field is the sum itself
        if zlib.crc32(memoryview(data)[_HEADER.size:], zlib.crc32(head)) != body_crc:
            raise ValueError("block checksum does not match")
        self.table, at = table, _HEADER.size
        numbers, at = np.frombuffer(data, "<i8", n, at), at + 8 * n
        nulls, at = np.frombuffer(data, "u1", n, at), at + n
        self.lengths, at = np.frombuffer(data, "<u8", n, at).astype(np.int64), at + 8 * n
        self.doc_ids = [None if z else int(v) for v, z in zip(numbers, nulls)]
        self.marks = []
        for _ in range(marks):
            self.marks.append((*struct.unpack_from("<II", data, at), np.frombuffer(data, "<u8", self.lanes, at + 8)))
            at += 8 + 8 * self.lanes
        self.words = np.frombuffer(data, "<u4", words, at)

    def decode_segment(self, k: int) -> np.ndarray:
        """The ids from checkpoint k to the next one."""
        first, pos, states = self.marks[k]
        last = self.marks[k + 1][0] if k + 1 < len(self.marks) else self.steps
        x, t = states.astype(np.uint64), self.table
        slots = t.slots
        out = np.empty(min(last * self.lanes, self.n_ids) - first * self.lanes, np.uint32)
        for at in range(0, len(out), self.lanes):
            s = x[:min(self.lanes, len(out) - at)]
            slot = s & _MASK
            ids = slots[slot.view(np.int64)]
            out[at:at + len(s)] = ids
            s >>= _SHIFT
            s *= t.freq[ids]
            slot -= t.first[ids]
            s += slot
            need = np.flatnonzero(s < _LOW)
            s[need] = (s[need] << _WORD) | self.words[pos:pos + len(need)]
            pos += len(need)
        return out

    def ids(self) -> np.ndarray:
        out = np.concatenate([self.decode_segment(k) for k in range(len(self.marks))]).astype("<u4")
        if zlib.crc32(out.tobytes()) != self.ids_crc:
            raise ValueError("ids checksum does not match")
        return out


def token_batches(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    tok = tokenizer(vocabulary)
    end = np.array([END_ID], tok.dtype).tobytes()
    for batch in batches:
        raw = [tok.raw(t.as_py()) + end for t in batch.column(1)]
        size = tok.dtype.itemsize
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(raw, pa.binary()), pa.array([len(r) // size for r in raw], pa.int64()),
             pa.array([zlib.crc32(r) for r in raw], pa.int64())], names=["doc_id", "raw", "n", "sum"])


def count_batches(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    tok = tokenizer(vocabulary)
    total = np.zeros(tok.size, np.int64)
    for batch in batches:
        total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), tok.dtype), minlength=tok.size)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())],
                                     names=["id", "count"])


def block_batches(batches: Iterator[pa.RecordBatch], freq: np.ndarray, vocabulary: str,
                  block_ids: int) -> Iterator[pa.RecordBatch]:
    """One partition's documents, in order -> its blocks."""
    from pyspark import TaskContext

    part, dtype, shared = TaskContext.get().partitionId(), tokenizer(vocabulary).dtype, Frequencies(freq)
    held: list[tuple[int | None, np.ndarray]] = []
    number = first = size = 0

    def block() -> pa.RecordBatch:
        row = {"part": part, "block": number, "first_id": first, "n_docs": len(held), "n_ids": size,
               "data": encode_block(held, shared)}
        return pa.RecordBatch.from_pylist([row], schema=pa.schema(
            [("part", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()), ("n_docs", pa.int64()),
             ("n_ids", pa.int64()), ("data", pa.binary())]))

    for batch in batches:
        for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held.append((doc_id, np.frombuffer(raw, dtype)))
            size += len(held[-1][1])
            if size >= block_ids:
                yield block()
                number, first, size, held = number + 1, first + size, 0, []
    if held:
        yield block()


def write_token_files(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, block_ids: int = BLOCK_IDS) -> str:
    """Encode every text into a token folder at ``path``; two passes over the ids, one
    over the texts."""
    spark = docs.sparkSession
    ship(spark)
    tokens = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("t"))
                   .mapInArrow(lambda it: token_batches(it, vocabulary), "doc_id long, raw binary, n long, sum long"),
                   "tokens")
    counts = (tokens.select("raw").mapInArrow(lambda it: count_batches(it, vocabulary), "id long, count long")
              .groupBy("id").agg(F.sum("count").alias("count"))).toPandas()  # a row per id of the vocabulary at most
    total = np.zeros(tokenizer(vocabulary).size, np.int64)
    total[counts["id"].to_numpy(np.int64)] = counts["count"].to_numpy(np.int64)
    freq = scale_counts(total)
    spark.createDataFrame(list(enumerate(freq.tolist())), "id int, freq int").coalesce(1).write.parquet(
        f"{path}/frequencies")
    parts = width(spark, int(total.sum()), IDS_PER_PART)
    order = [F.col("doc_id").asc_nulls_first(), F.col("sum"), F.col("n")]
    (tokens.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "raw")
     .mapInArrow(lambda it: block_batches(it, freq, vocabulary, block_ids),
                 "part int, block int, first_id long, n_docs long, n_ids long, data binary")
     .write.option("compression", "none").parquet(f"{path}/blocks"))
    return path


_SHARED: dict[int, Frequencies] = {}


def read_batches(batches: Iterator[pa.RecordBatch], freq: np.ndarray, with_ids: bool) -> Iterator[pa.RecordBatch]:
    crc = zlib.crc32(freq.astype("<u4").tobytes())
    if crc not in _SHARED:
        _SHARED.clear()
        _SHARED[crc] = Frequencies(freq)
    for batch in batches:
        for part, first, data in zip(*[c.to_pylist() for c in batch.columns]):
            block = Block(data, _SHARED[crc])
            ids = block.ids()
            ends = np.cumsum(block.lengths)
            starts = ends - block.lengths
            cols = [pa.array([part] * len(ends), pa.int32()), pa.array(block.doc_ids, pa.int64()),
                    pa.array(first + starts, pa.int64()), pa.array(block.lengths, pa.int64()),
                    pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)], pa.int64())]
            names = ["part", "doc_id", "at", "n_tokens", "ids_crc32"]
            if with_ids:
                cols.append(pa.array([ids[a:b].astype(np.int32) for a, b in zip(starts, ends)], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document, from the files."""
    ship(spark)
    rows = spark.read.parquet(f"{path}/frequencies").toPandas().sort_values("id")  # a row per id of the vocabulary
    freq = rows["freq"].to_numpy(np.int64)
    blocks = spark.read.parquet(f"{path}/blocks")
    # One row per part: ids of all parts before it.
    bases = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(
        F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    schema = "part int, doc_id long, at long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    read = blocks.select("part", "first_id", "data").mapInArrow(lambda it: read_batches(it, freq, with_ids), schema)
    keep = ["n_tokens", "ids_crc32"] + (["ids"] if with_ids else [])
    return read.join(bases, "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"), *keep)


def token_digests(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Write the files to the shared checkpoint folder and read them back."""
    path = write_token_files(docs, scratch_path(docs.sparkSession, "token-files"), vocabulary)
    return read_token_files(docs.sparkSession, path)
