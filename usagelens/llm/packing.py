"""Sequences of at most 4096 tokens by first-fit decreasing with a tournament tree.

A document's ids (its text's ids and the end id) are cut every ``capacity`` ids into
pieces; a full piece is a sequence by itself. The rest, one short piece per document,
is dealt at random (a hash of the piece's number) into groups of about ``group_size``
pieces. Every group is packed alone: longest piece first, each into the first open
sequence that has room. The leaves of a tournament tree are the room left in each
sequence and an inner node holds the largest room below it, so the first that fits is
found in log2(n) steps.

Only counts and checksums leave the tokenizing stage, and they are staged once, so the
numbers that deal pieces to groups are fixed and no text is encoded twice.

Cases: a null or empty text is one piece holding only the end id; repeated rows are
packed as separate documents; a text of any length is cut the same way; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import ship, stage, text_or_empty
from usagelens.llm.tokens import END_ID, VOCABULARY, tokenizer

CAPACITY = 4096
GROUP_SIZE = 4096

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = PIECES + ", sequence_id long, offset long"


def piece_batches(batches: Iterator[pa.RecordBatch], capacity: int, vocabulary: str) -> Iterator[pa.RecordBatch]:
    """(doc_id, t) batches -> the pieces of each document."""
    tok = tokenizer(vocabulary)
    end = np.array([END_ID], "<u4")
    for batch in batches:
        rows: list[list] = [[], [], [], [], []]
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids = np.concatenate([tok.ids(text.as_py()).astype("<u4"), end])
            for at in range(0, len(ids), capacity):
                part = ids[at:at + capacity]
                for column, v in zip(rows, (doc_id, at, len(part), zlib.crc32(part.tobytes()), len(ids))):
                    column.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows],
                                         names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    ship(docs.sparkSession)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("t"))
            .mapInArrow(lambda it: piece_batches(it, capacity, vocabulary), PIECES))


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length; ``lengths`` are in 1..capacity and already falling."""
    n = len(lengths)
    leaves = 1 << max(0, (n - 1).bit_length())
    room = [capacity] * (2 * leaves)  # node k has children 2k and 2k+1
    bins, offsets = [0] * n, [0] * n
    for i, need in enumerate(lengths.tolist()):
        k = 1
        while k < leaves:
            k *= 2
            if room[k] < need:
                k += 1
        bins[i], offsets[i] = k - leaves, capacity - room[k]
        room[k] -= need
        while k > 1:
            k //= 2
            a, b = room[2 * k], room[2 * k + 1]
            largest = a if a >= b else b
            if room[k] == largest:
                break
            room[k] = largest
    return np.array(bins, np.int64), np.array(offsets, np.int64)


def pack(cut: DataFrame, capacity: int = CAPACITY, group_size: int = GROUP_SIZE) -> DataFrame:
    """Pieces with sequence_id (group number times 2^32, plus the sequence in the group)
    and offset."""
    spark = cut.sparkSession
    ship(spark)
    cut = stage(cut.withColumn("no", F.monotonically_increasing_id()), "pieces")
    full = F.col("length") == capacity
    short = cut.where(~full)
    groups = max(1, -(-short.count() // group_size))
    names = [x.split()[0] for x in PACKED.split(", ")]

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "no"], ascending=[False, True], kind="stable")
        bins, offsets = first_fit_decreasing(group["length"].to_numpy(), capacity)
        return group.assign(sequence_id=(group["grp"].to_numpy() << 32) + bins, offset=offsets)[names]

    filled = (short.withColumn("grp", F.pmod(F.xxhash64("no", F.lit(20260101)), F.lit(groups)))
              .groupBy("grp").applyInPandas(fill, PACKED))
    # Full pieces: sequences numbered from 2^62 by their own number.
    whole = cut.where(full).select(*names[:5], (F.col("no") + F.lit(1 << 62)).alias("sequence_id"),
                                   F.lit(0).cast("long").alias("offset"))
    return filled.unionByName(whole)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, group_size: int = GROUP_SIZE,
                   vocabulary: str = VOCABULARY) -> DataFrame:
    return pack(pieces(docs, capacity, vocabulary), capacity, group_size)
