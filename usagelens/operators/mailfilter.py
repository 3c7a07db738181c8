"""A filter of the picked employees' emails, tested in the fact scan (F1).

Where the dimension is too large to broadcast, the page's picks (practice, level, location)
would only act at the join, after every fact row has been aggregated and shuffled. A Bloom
filter of the picked emails is small whatever the facts: ``BITS_PER_EMAIL`` bits each, at most
``MOST_BITS`` in all (4 MiB). It is built by one aggregate, written once as a table of one row, and
each query reads it as a scalar subquery, so fact rows of other employees are dropped
before the partial aggregate by JVM expressions over a constant array. It may let a few others
pass (about 0.7 %), which the join then drops: results are exact with and without it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.session import stage_table

BITS_PER_EMAIL = 12
MOST_BITS = 1 << 25
LEAST_BITS = 1 << 10
# Beyond this share of the dimension the filter drops too little to pay for its test.
MOST_SHARE = 0.5


def _positions(email: Column, bits: int) -> list[Column]:
    """Four places of an email: two from each of two hashes (``bits`` is a power of two)."""
    out = []
    for seed in (1, 2):
        h = F.xxhash64(email, F.lit(seed))
        out += [h.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(h, 25).bitwiseAND(F.lit(bits - 1))]
    return out


@dataclass(frozen=True)
class MailFilter:
    """``words`` has one row: an array of ``bits / 64`` longs."""

    words: DataFrame
    bits: int

    def passes(self, email: str) -> Column:
        """False for an email that was not picked, but for a few; NULL emails never pass."""
        words = self.words.scalar()
        tests = [F.getbit(F.get(words, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1
                 for p in _positions(F.col(email), self.bits)]
        return F.col(email).isNotNull() & reduce(lambda a, b: a & b, tests)


def filter_bits(emails: int) -> int:
    """The power of two that gives ``emails`` their bits."""
    bits = LEAST_BITS
    while bits < emails * BITS_PER_EMAIL:
        bits *= 2
    return bits


def build_mail_filter(employees: DataFrame, picked: Column) -> MailFilter | None:
    """The filter of the employees for which ``picked`` holds; None where it would not pay: too
    many bits, or more than ``MOST_SHARE`` of the dimension. No picked employee at all is a
    filter that nothing passes."""
    row = employees.agg(F.count("email").alias("n"), F.count(F.when(picked, F.col("email"))).alias("some")).first()
    bits = filter_bits(row["some"])
    if bits > MOST_BITS or row["some"] > MOST_SHARE * row["n"]:
        return None
    spark = employees.sparkSession
    marks = (employees.where(picked & F.col("email").isNotNull())
             .select(F.explode(F.array(*_positions(F.col("email"), bits))).alias("at"))
             .select(F.shiftright("at", 6).alias("word"),
                     F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bits")))
    every = spark.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = marks.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    row_of = words.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("words"))
    return MailFilter(stage_table(row_of, "mail-filter"), bits)
