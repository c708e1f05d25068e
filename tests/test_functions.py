from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterline.functions import hashing, numeric, temporal, text, trip
from meterline.schema import EXPLORER_PAYMENT_LABELS, PAYMENT_LABELS


def column(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def half_up(value: float, digits: int) -> float:
    step = Decimal(1).scaleb(-digits)
    return float(Decimal(repr(value)).quantize(step, rounding=ROUND_HALF_UP))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.one_of(
            st.floats(-1e6, 1e6),
            st.integers(-100_000, 100_000).map(lambda i: i / 1000),
            st.integers(-10_000, 10_000).map(lambda i: i / 200),
            st.floats(-1e14, 1e14),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_rounding_is_half_up_on_decimal_text(spark, values):
    got = column(spark, values).select(numeric.round_half_up("x", 2).alias("r"), "x").collect()
    for row in got:
        assert row.r == half_up(row.x, 2), row.x


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 2_100_000).map(lambda i: i / 10_000), min_size=1, max_size=60))
def test_unrounded_bounds_agree_with_rounded_ones(spark, values):
    values = [*values, 0.495, 0.4949999, 180.005, 180.00499999999999, 100.005]
    quick = numeric.rounds_into("x", 0.5, 180.0, 2)
    slow = F.round("x", 2).between(0.5, 180.0)
    assert column(spark, values).filter(quick != slow).count() == 0


def test_ratio_by_zero_is_null(spark):
    frame = spark.createDataFrame([(1.0, 0.0), (1.0, 3.0)], "a double, b double")
    got = [r.r for r in frame.select(numeric.ratio("a", "b", 4).alias("r")).collect()]
    assert got == [None, 0.3333]


def test_clip(spark):
    got = column(spark, [-1.0, 5.0, 90.0, None]).select(numeric.clip("x", 0.0, 80.0).alias("c"))
    assert [r.c for r in got.collect()] == [0.0, 5.0, 80.0, None]


@pytest.mark.parametrize(
    "hour, part",
    [(0, "night"), (5, "night"), (6, "morning"), (11, "morning"), (12, "afternoon"),
     (17, "afternoon"), (18, "evening"), (23, "evening")],
)
def test_day_part(spark, hour, part):
    assert column(spark, [hour], "int").select(temporal.day_part("x").alias("p")).first().p == part


def test_weekend(spark):
    got = column(spark, range(1, 8), "int").select(temporal.weekend_flag("x").alias("w"))
    assert [r.w for r in got.collect()] == [1, 0, 0, 0, 0, 0, 1]


def test_period_is_half_open_for_both_timestamp_types(spark):
    moments = ["2022-12-31 23:59:59", "2023-01-01 00:00:00", "2023-12-31 23:59:59", "2024-01-01 00:00:00"]
    for kind in ("timestamp", "timestamp_ntz"):
        frame = column(spark, moments, "string").select(F.col("x").cast(kind).alias("x"))
        got = frame.select(temporal.within_days("x", "2023-01-01", "2024-01-01").alias("in"))
        assert [r["in"] for r in got.collect()] == [False, True, True, False]


def test_airport_flag_ignores_nulls(spark):
    rows = [(1, 5), (5, 132), (138, None), (None, None), (2, 3)]
    frame = spark.createDataFrame(rows, "pulocationid long, dolocationid long")
    assert [r.f for r in frame.select(trip.airport_flag().alias("f")).collect()] == [1, 1, 1, 0, 0]


def test_label_uses_the_rounded_share(spark):
    rows = [(0.20, 0), (0.20004, 0), (0.20006, 1), (None, 0)]
    frame = spark.createDataFrame([(t, 1.0, want) for t, want in rows], "tip double, fare double, want int")
    share = trip.tip_share("tip", "fare")
    assert frame.filter(trip.generous_flag(share) != F.col("want")).count() == 0


def test_decode_and_encode(spark):
    codes = column(spark, [1, 2, 5, 9], "long")
    shown = codes.select(text.decode(F.col("x"), EXPLORER_PAYMENT_LABELS).alias("t"))
    assert [r.t for r in shown.collect()] == ["Credit Card", "Cash", "5", "9"]
    labels = column(spark, ["Voided", "Nothing"], "string")
    back = labels.select(text.encode(F.col("x"), PAYMENT_LABELS).alias("c"))
    assert [r.c for r in back.collect()] == [6, None]


def test_display_text(spark):
    frame = spark.createDataFrame([(0.76, 1), (0.06, 0)], "c double, p int")
    got = frame.select(text.percent_text(F.col("c")).alias("c"), text.decision_text(F.col("p")).alias("p"))
    assert [tuple(r) for r in got.collect()] == [
        ("76.0%", "Generous Tipper"),
        ("6.0%", "Not a Generous Tipper"),
    ]


def test_hashes_stay_in_range_and_spread(spark):
    for made in (hashing.row_hash(["id"]), hashing.portable_hash(["id"])):
        found = spark.range(4000).select(made.alias("h")).agg(
            F.min("h").alias("low"), F.max("h").alias("high"), F.countDistinct("h").alias("n")
        ).first()
        assert 0 <= found.low and found.high < hashing.HASH_SPACE and found.n == 4000
        below = spark.range(4000).filter(made < int(0.25 * hashing.HASH_SPACE)).count()
        assert 850 < below < 1150
