"""Document frequencies of term classes: 2^SLOT_BITS numbers whatever the vocabulary, for
operators that only ask whether a term is common."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import ship, text_or_empty
from usagelens.llm.imatch import terms

SLOT_BITS = 18


def slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << SLOT_BITS, np.int64)
    docs = 0
    for batch in batches:
        for t in batch.column(0):
            total[np.unique(slots(terms(t.as_py())))] += 1
            docs += 1
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], docs))],
                                     names=["slot", "n"])


def class_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents per term class, and documents in all; summed over all rows."""
    ship(docs.sparkSession)
    rows = (docs.select(text_or_empty().alias("t")).mapInArrow(count_batches, "slot long, n long")
            .groupBy("slot").agg(F.sum("n").alias("n")).toPandas())  # 2^SLOT_BITS + 1 rows at most
    total, docs_n = np.zeros(1 << SLOT_BITS, np.int64), 0
    for slot, n in zip(rows["slot"].to_numpy(), rows["n"].to_numpy()):
        if slot < 0:
            docs_n = int(n)
        else:
            total[slot] = n
    return total, docs_n
