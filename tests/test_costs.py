import math
import random
import struct
from dataclasses import replace
from decimal import Context, Decimal
from fractions import Fraction

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from usagelens.operators.costs import BinnedCosts, PlainCosts, measure_costs
from usagelens.operators.rollups import UsagePage
from usagelens.sources.standin import extreme_requests, standin_tables

WIDE = Context(prec=1500)


def rounded(value: Fraction, scale: int) -> float:
    """Half away from zero, then to the nearest double."""
    units = abs(value) * 10 ** scale
    whole = units.numerator // units.denominator
    whole += units - whole >= Fraction(1, 2)
    return float(Decimal(whole if value >= 0 else -whole).scaleb(-scale, WIDE))


def exact(costs):
    return sum((Fraction(Decimal(repr(c))) for c in costs if c is not None), Fraction(0))


def sums(spark, groups, costs):
    """(sum, average) of every group: from rows, and from parts summed twice before."""
    rows = [(g, i % 3, c) for g, values in groups.items() for i, c in enumerate(values)]
    facts = spark.createDataFrame(rows, "g string, part int, cost_usd double").repartition(3)
    parts = costs.prepare(facts).select("g", "part", *[c.alias(n) for n, c in costs.parts().items()])
    twice = parts
    for keys in (["g", "part"], ["g"]):
        twice = twice.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in costs.names])
    out = []
    for frame in (parts, twice):
        found = frame.groupBy("g").agg(costs.money(2).alias("m"), costs.average(4).alias("a")).collect()
        out.append({r["g"]: (r["m"], r["a"]) for r in found})
    assert sorted(map(repr, out[0].items())) == sorted(map(repr, out[1].items()))  # NaN equals itself here
    return out[0]


def any_double(r):
    while True:
        x = struct.unpack("<d", r.randbytes(8))[0]
        if math.isfinite(x):
            return x


def groups_of_all_sizes():
    r = random.Random(8)
    groups = {
        "cancel": [1e300, 5.0, -1e300, 0.005], "tiny": [1e-300] * 5, "least": [5e-324, -5e-324, 5e-324], "most": [1.7976931348623157e308] * 2,
        "under": [0.0149999999999999994], "tie": [0.125, 0.0], "down": [-0.125], "nines": [9.995, 0.0], "carry": [999999999999999.9, 0.1],
        "minus": [-1e23, 3.0], "third": [1e23, 1.0, 1.0], "null": [None, 2.5, None], "none": [None], "zero": [0.0, -0.0],
        "sixteen": [0.1 + 0.2] * 7, "plain": [12.34, 0.0012345678901234567, 7e6, 1e7, 123456789.125], "nan": [math.nan, 1.0],
        "inf": [math.inf, 1e300], "neg": [-math.inf],
    }
    for i in range(150):
        groups[f"any{i}"] = [any_double(r) for _ in range(r.randrange(1, 6))]
        groups[f"near{i}"] = [round(r.uniform(-100, 100), r.randrange(18)) for _ in range(r.randrange(1, 9))]
        e = r.randrange(-330, 300)
        groups[f"alike{i}"] = [r.choice((1, -1)) * float(f"{r.random()}e{e}") for _ in range(4)]
    return groups


def test_any_doubles_sum_exactly(spark):
    groups = groups_of_all_sizes()
    got = sums(spark, groups, BinnedCosts())
    for g, costs in groups.items():
        some = [c for c in costs if c is not None]
        odd = [c for c in some if not math.isfinite(c)]
        if odd:
            assert all(math.isnan(x) if math.isnan(odd[0]) else x == odd[0] for x in got[g]), g
        elif not some:
            assert got[g] == (None, None)
        else:
            total = exact(some)
            assert got[g] == (rounded(total, 2), rounded(total / len(some), 4)), g


def test_form_follows_the_costs(spark):
    def form(costs):
        return measure_costs(spark.createDataFrame([(c,) for c in costs], "cost_usd double"))

    for plain in ([], [None], [math.nan, math.inf], [0.0], [12.34, -0.000001], [2e10, 1e-12], [1e21]):
        assert isinstance(form(plain), PlainCosts), plain
    for binned in ([1e23], [-1e300, 1e-16], [0.1 + 0.2], [5e-324], [1e21] * 20):
        costs = form(binned)
        assert isinstance(costs, BinnedCosts), binned
        if len(costs.bins) < 6:  # all bins: the test above
            assert sums(spark, {"x": binned}, costs)["x"] == (rounded(exact(binned), 2), rounded(exact(binned) / len(binned), 4))
    assert len(form([0.1 + 0.2, 1.0]).bins) <= 4


def test_plain_and_binned_agree(spark):
    r = random.Random(4)
    groups = {str(i): [round(r.uniform(-1000, 1000), r.randrange(9)) for _ in range(40)] for i in range(40)}
    assert sums(spark, groups, PlainCosts()) == sums(spark, groups, BinnedCosts())


@pytest.mark.parametrize("method", ["kpi", "tokens_by_level", "top_engineers"])
def test_plan_shapes_agree_on_costs_of_any_size(spark, method):
    t = standin_tables(spark, SF_SMALL)
    t = replace(t, api_requests=extreme_requests(t.api_requests, any_size=True))
    rows = [getattr(UsagePage(t, broadcast=b), method)().collect() for b in (True, False)]
    shared = UsagePage(t, broadcast=True).share()
    rows.append(getattr(shared, method)().collect())
    shared.unshare()
    assert rows[0] == rows[1] == rows[2] and rows[0]


def test_ordinary_page_keeps_one_decimal_and_hour_query_measures_nothing(spark):
    page = UsagePage(standin_tables(spark, SF_SMALL), broadcast=True)
    page.hour_dow()
    assert "costs" not in vars(page)
    page.daily_usage()
    assert isinstance(page.costs, PlainCosts)
