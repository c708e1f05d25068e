"""Exact sums against fractions: any size, any order, any mixture."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from meterline.functions.exact import exact_means, exact_sums

SORTS = {
    "any size": lambda r: r.uniform(-1, 1) * 10.0 ** r.randint(-300, 300),
    "money": lambda r: round(r.uniform(0, 100), 2),
    "least": lambda r: r.choice([5e-324, -5e-324, 1e-310, 2.2250738585072014e-308, 1.0]),
    "greatest": lambda r: r.choice([1e308, -1e308, 1.7976931348623157e308, 1.0, -1.0]),
    "small": lambda r: r.uniform(1e-5, 1e-3),
    "ties": lambda r: r.choice([1.0, 2.0**-53, 2.0**-54, -(2.0**-54), 2.0**-105]),
    "nan": lambda r: r.choice([float("nan"), 1.0, 1e300]),
    "one infinity": lambda r: r.choice([float("inf"), 1.0, None]),
    "both infinities": lambda r: r.choice([float("inf"), float("-inf")]),
    "nothing": lambda r: None,
    "zeros": lambda r: r.choice([0.0, -0.0]),
    "cancelling": lambda r: r.choice([1e16, -1e16, 1.0, 3.0, 1e-300]),
    "edges of bands": lambda r: r.choice([-1, 1]) * 2.0 ** r.choice([-21, -20, -19, 27, 28, 29, 75, 76, -68, -69, 1000, -1060]) * r.choice([1, 1 - 2.0**-53, 1 + 2.0**-52]),
}


def nearest(values) -> float | None:
    """The double nearest to the true sum."""
    values = [v for v in values if v is not None]
    if not values:
        return None
    endless = {v for v in values if math.isinf(v)}
    if any(math.isnan(v) for v in values) or len(endless) == 2:
        return float("nan")
    if endless:
        return endless.pop()
    total = sum(map(Fraction, values))
    try:
        return float(total)
    except OverflowError:
        return math.inf if total > 0 else -math.inf


def same(a, b) -> bool:
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    return [(f"{name} {k}", make(rng), rng.uniform(0, 50)) for name, make in SORTS.items() for k in range(4) for _ in range(rng.randint(1, 60))]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_of_every_sort(spark, rows, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        made = spark.createDataFrame(rows, "g string, a double, b double")
        found = [exact_sums(df, ["g"], ["a", "b"]).collect() for df in (made, made.repartition(7).sortWithinPartitions("b"))]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    for got in found:
        assert len(got) == len({g for g, _, _ in rows})
        for r in got:
            own = [row for row in rows if row[0] == r.g]
            assert r.row_count == len(own) and r.n_a == sum(a is not None for _, a, _ in own)
            assert same(r.sum_a, nearest([a for _, a, _ in own])), r
            assert r.sum_b == nearest([b for _, _, b in own])


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=30))
def test_sum_of_any_doubles(spark, values):
    row = exact_sums(spark.createDataFrame([(v,) for v in values], "v double"), [], ["v"]).first()
    assert row.sum_v == nearest(values) and row.n_v == len(values)


def test_no_rows_no_keys_and_other_types(spark):
    df = spark.createDataFrame([(None, 1, 0.1), (None, 2, 0.2), ("x", None, 0.3)], "`a key` string, n int, v float")
    got = {r["a key"]: r for r in exact_sums(df, ["a key"], ["n", "v"]).collect()}
    assert got[None].sum_n == 3.0 and got["x"].sum_n is None and got["x"].n_n == 0 and got["x"].row_count == 1
    none = exact_sums(df.limit(0), [], ["n"]).collect()
    assert [tuple(r) for r in none] == [(0, None, 0)] and exact_sums(df.limit(0), ["a key"], ["n"]).count() == 0
    assert exact_means(df, [], ["n"]).first().mean_n == 1.5 and exact_means(df.limit(0), [], ["n"]).first().mean_n is None


@pytest.mark.parametrize(
    ("values", "mean"),
    [([1e-9, 3e-9], 2e-9), ([2e11, 4e11], 3e11), ([1.0, float("nan")], float("nan")), ([1.0, float("inf")], float("inf")),
     ([0.1, 0.2, None], 0.15), ([None, None], None), ([0.0, 1e-12], 5e-13), ([9e10, 9e10], 9e10), ([-1e300, 3e300], 1e300),
     ([0.000123456789, 0.000123456781], 0.000123456785)],
)
def test_means_of_any_size(spark, values, mean):
    got = exact_means(spark.createDataFrame([(v,) for v in values], "v double"), [], ["v"]).first().mean_v
    assert got == pytest.approx(mean, rel=1e-15, nan_ok=True) if mean is not None else got is None


def test_sums_in_any_layout_have_the_same_bits(spark):
    values = [0.1, 0.2, 0.3, -7.25, 1e6, 123.45678] * 50
    ways = [spark.createDataFrame([(v,) for v in order], "v double").repartition(n) for order, n in ((values, 1), (values[::-1], 7), (sorted(values), 3))]
    assert {exact_sums(df, [], ["v"]).first().sum_v for df in ways} == {nearest(values)}
