"""Sums and averages of costs, exact and order-free for doubles of any size.

A cost is the decimal its text shows (the shortest that reads back as the same double). A
query sums additive *parts* of it, so partial sums may be summed again in any order and every
plan shape gives the same number, rounded once at the end:

* ``PlainCosts``: one DECIMAL(38,15) part, where a look at the costs shows that each fits it exactly and
  their sum cannot leave it. This is the form of ordinary costs.
* ``BinnedCosts``: a part per 15 decimal digits between the smallest and the largest cost. A cost falls
  into three neighbouring bins at most; a bin's sum is a whole number with room for 10^23 rows.
  At the end, carries are taken from the lowest bin to the highest, and the digits, as
  text, are rounded half-up or divided by the count chunk by chunk.

``measure_costs`` picks the form by one aggregate over the costs a page is about (no rows to the driver).
NULL costs count nowhere; a NaN or infinite cost makes its group's sum and average NaN or infinite.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COST_TYPE = "decimal(38,15)"
STEP = 15
_WHOLE = "decimal(38,0)"
_PLAIN_SUM = 1e22  # a tenth of what COST_TYPE holds
_LOWEST, _HIGHEST = (-324 - 20) // STEP, 308 // STEP


def _finite() -> Column:
    c = F.col("cost_usd")
    return ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def odd_cost() -> Column:
    """The non-finite costs, as a double that sums to NaN or infinity; 0 for others."""
    return F.when(F.col("cost_usd").isNull() | _finite(), F.lit(0.0)).otherwise(F.col("cost_usd"))


def _cost_n() -> Column:
    return F.when(F.col("cost_usd").isNotNull(), F.lit(1)).cast("long")


def _or_odd(value: Column) -> Column:
    odd = F.sum("odd_cost")
    return F.when(odd != 0, odd).otherwise(value)


def half_up_quotient(total: Column, count: Column, scale: int) -> Column:
    """``total / count`` rounded half away from zero to ``scale`` digits; NULL for count 0.

    Exact: ``total`` (COST_TYPE or BIGINT) is split into whole and fraction, scaled by
    2 * 10^scale as integers, and divided once."""
    unit, size = 10 ** scale, F.abs(total.cast(COST_TYPE))
    whole = F.floor(size).cast("decimal(23,0)")
    fraction = F.floor((size % F.lit(1).cast("decimal(1,0)")) * F.lit(2 * unit)).cast("decimal(10,0)")
    halves = (whole * F.lit(2 * unit).cast("decimal(7,0)")).cast("decimal(32,0)") + fraction + count.cast("decimal(20,0)")
    n = F.when(count > 0, count)
    quotient = F.call_function("div", halves.cast("decimal(38,0)"), (n * 2).cast("decimal(38,0)"))
    return F.when(total < 0, -quotient).otherwise(quotient).cast("double") / F.lit(float(unit))


class PlainCosts:
    """Costs that DECIMAL(38,15) holds, and whose sum it holds."""

    names = ("cost", "cost_n", "odd_cost")

    def prepare(self, facts: DataFrame) -> DataFrame:
        return facts

    def parts(self) -> dict[str, Column]:
        """The additive parts of a cost sum or average, over ``prepare``'s rows."""
        return {"cost": F.when(_finite(), F.col("cost_usd").try_cast(COST_TYPE)), "cost_n": _cost_n(), "odd_cost": odd_cost()}

    def money(self, scale: int = 2) -> Column:
        """The rounded sum of a group's costs, as DOUBLE, over summed or unsummed parts."""
        return _or_odd(F.round(F.sum("cost"), scale).cast("double"))

    def average(self, scale: int) -> Column:
        return _or_odd(half_up_quotient(F.sum("cost"), F.sum("cost_n"), scale))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body).getItem(0)


def _unit() -> Column:
    return F.lit(10 ** STEP).cast("decimal(16,0)")


def _without_remainder(value: Column, rest: Column, by: Column) -> Column:
    return ((value - rest) / by).cast(_WHOLE)


def _padded(number: Column) -> Column:
    return F.lpad(number.cast("string"), STEP, "0")


def _carried(sums: Column) -> Column:
    """struct(carry, digits) of bin sums, lowest first: the number is ``carry`` followed by ``digits``."""
    def add(done: Column, s: Column) -> Column:
        value = (s + done["carry"]).cast(_WHOLE)
        low = F.pmod(value, _unit()).cast(_WHOLE)
        return F.struct(_without_remainder(value, low, _unit()).alias("carry"),
                        F.concat(_padded(low), done["digits"]).alias("digits"))

    return F.aggregate(sums, F.struct(F.lit(0).cast(_WHOLE).alias("carry"), F.lit("").alias("digits")), add)


def _divided(digits: Column, count: Column) -> Column:
    """Digits of floor(digits / count), in chunks from the left."""
    n = count.cast("decimal(20,0)")

    def chunks(whole: Column) -> Column:
        def step(done: Column, at: Column) -> Column:
            value = ((done["rest"] * _unit()).cast(_WHOLE) + F.substring(whole, at, STEP).cast("decimal(15,0)")).cast(_WHOLE)
            rest = (value % n).cast(_WHOLE)
            return F.struct(rest.alias("rest"), F.concat(done["digits"], _padded(_without_remainder(value, rest, n))).alias("digits"))

        start = F.struct(F.lit(0).cast(_WHOLE).alias("rest"), F.lit("").alias("digits"))
        return F.aggregate(F.sequence(F.lit(1), F.length(whole), F.lit(STEP)), start, step)["digits"]

    return _let(F.lpad(digits, F.ceil(F.length(digits) / F.lit(STEP)).cast("int") * F.lit(STEP), "0"), chunks)


def _half_up(digits: Column, drop: int, scale: int) -> Column:
    """A whole number in units of 10^-(drop + scale), as text, rounded to 10^-scale, as DOUBLE."""
    def rounded(whole: Column) -> Column:
        up = F.substring(whole, F.length(whole) - F.lit(drop - 1), F.lit(1)) >= "5"
        kept = F.substring(whole, F.lit(1), F.length(whole) - F.lit(drop))
        return _let(kept, lambda k: F.when(up, plus_one(k)).otherwise(k))

    def plus_one(kept: Column) -> Column:
        def carry(head: Column) -> Column:  # never empty: ``kept`` starts with 0
            last = (F.right(head, F.lit(1)).cast("int") + F.lit(1)).cast("string")
            return F.concat(F.substring(head, F.lit(1), F.length(head) - F.lit(1)), last,
                            F.repeat(F.lit("0"), F.length(kept) - F.length(head)))

        return _let(F.rtrim(kept, F.lit("9")), carry)

    whole = _let(digits, lambda d: F.concat(F.lit("0"), F.lpad(d, F.greatest(F.length(d), F.lit(drop + 1)), "0")))
    return F.concat(_let(whole, rounded), F.lit(f"E-{scale}")).cast("double")


def _with_shortest(facts: DataFrame) -> DataFrame:
    """``facts`` with ``_text``, the shortest text that reads back as the same double (NULL if not finite).
    Java's own (before 19) may have 16 or 17 digits where 15 or 16 would do. Each step is a column of its own,
    so that none is computed again wherever it is used."""
    size = F.abs("cost_usd")
    facts = facts.withColumn("_java", F.when(_finite(), size.cast("string")))
    long = F.length(F.substring_index("_java", "E", 1)) > 16
    facts = facts.withColumn("_15", F.when(long, F.upper(F.format_string("%.14e", size))))
    facts = facts.withColumn("_16", F.when(F.col("_15").cast("double") != size, F.upper(F.format_string("%.15e", size))))
    shorter = F.when(F.col("_16").isNull(), F.col("_15")).when(F.col("_16").cast("double") == size, F.col("_16"))
    return facts.withColumn("_text", F.coalesce(shorter, "_java")).drop("_java", "_15", "_16")


class BinnedCosts:
    """Costs between any two powers of ten: bin k holds whole multiples of 10^(15 k)."""

    def __init__(self, low: int = _LOWEST, high: int = _HIGHEST):
        self.low, self.high = min(low, -1), max(high, 0)
        self.bins = [f"cost_{i}" for i in range(self.high - self.low + 1)]
        self.names = (*self.bins, "cost_n", "odd_cost")

    def prepare(self, facts: DataFrame) -> DataFrame:
        """``facts`` with each cost's lowest bin and its three pieces."""
        text, mantissa, exponent = F.col("_text"), F.col("_mantissa"), F.col("_exponent")
        sign = F.when(F.col("cost_usd") < 0, F.lit(-1)).otherwise(F.lit(1)).cast("long")
        pieces = F.array(*[F.substring("_digits", 1 + STEP * (2 - i), STEP).cast("long") * sign for i in range(3)])
        steps = [  # columns, as in _with_shortest
            {"_mantissa": F.substring_index(text, "E", 1),
             "_exponent": F.when(F.contains(text, F.lit("E")), F.substring_index(text, "E", -1).cast("int")).otherwise(0)},
            {"_whole": F.substring_index(mantissa, ".", 1), "_fraction": F.substring_index(mantissa, ".", -1)},
            {"_last": exponent - F.length("_fraction")},
            {"_shift": F.pmod("_last", F.lit(STEP))},
            {"_digits": F.lpad(F.concat("_whole", "_fraction", F.repeat(F.lit("0"), F.col("_shift"))), 3 * STEP, "0")},
            {"_cost_bins": F.when(text.isNotNull(), F.struct(((F.col("_last") - F.col("_shift")) / STEP).cast("int").alias("bin"),
                                                             pieces.alias("pieces")))}]
        out = _with_shortest(facts)
        for step in steps:
            out = out.withColumns(step)
        return out.select(*facts.columns, "_cost_bins")

    def parts(self) -> dict[str, Column]:
        lowest, pieces = F.col("_cost_bins.bin"), F.col("_cost_bins.pieces")
        out = {}
        for i, name in enumerate(self.bins):
            at = F.lit(self.low + i) - lowest
            out[name] = F.when(at.between(0, 2), F.get(pieces, at)).cast(_WHOLE)
        return {**out, "cost_n": _cost_n(), "odd_cost": odd_cost()}

    def _rounded(self, scale: int, count: Column | None) -> Column:
        drop = -STEP * self.low - scale
        sums = F.array(*[F.coalesce(F.sum(n), F.lit(0)).cast(_WHOLE) for n in self.bins])

        def number(c: Column) -> Column:
            digits = F.concat(c["carry"].cast("string"), c["digits"])
            return _half_up(digits if count is None else _divided(digits, count), drop, scale)

        def signed(s: Column) -> Column:
            up = _let(_carried(s), lambda c: F.when(c["carry"] >= 0, number(c)))
            down = _let(_carried(F.transform(s, lambda x: (-x).cast(_WHOLE))), lambda c: -number(c))
            return F.coalesce(up, down)

        return _or_odd(F.when(F.sum("cost_n") > 0, _let(sums, signed)))

    def money(self, scale: int = 2) -> Column:
        """As ``PlainCosts.money``."""
        return self._rounded(scale, None)

    def average(self, scale: int) -> Column:
        return self._rounded(scale, F.sum("cost_n"))


def fits_plain(most: float | None, n: int) -> bool:
    """Whether ``n`` values of at most this size can be summed by ``PlainCosts``."""
    return (most or 0.0) * n < _PLAIN_SUM


def measure_costs(facts: DataFrame) -> PlainCosts | BinnedCosts:
    """The form for the costs of these rows: one aggregate over one column."""
    size = F.when(_finite(), F.abs("cost_usd"))
    whole = size.try_cast(COST_TYPE)
    lossy = whole.isNull() | (whole.cast("double") != size)
    row = facts.agg(F.count(size).alias("n"), F.max(size).alias("most"), F.min(F.when(size > 0, size)).alias("least"),
                    F.max(F.when(size.isNotNull(), lossy)).alias("lossy")).first()
    if not row["lossy"] and fits_plain(row["most"], row["n"]):
        return PlainCosts()
    # A cost's text has at most 17 digits; three more for renderings that aren't the shortest.
    first, last = (Decimal(repr(row[c])).adjusted() for c in ("least", "most"))
    return BinnedCosts((first - 20) // STEP, last // STEP)
