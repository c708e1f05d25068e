from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.functions import hashing
from meterline.operators import cleaning, explore, profile, reports, sampling
from meterline.schema import TripLimits


def values(spark, numbers):
    return spark.createDataFrame([(float(v) if v is not None else None,) for v in numbers], "v double")


@pytest.mark.parametrize(
    "numbers, bins",
    [
        ([1, 2, 2, 3, 10], 4),
        ([5, 5, 5], 10),
        (list(np.random.default_rng(7).normal(20, 9, 3000)), 40),
        ([i / 10 for i in range(0, 801)], 40),
        ([0, 80, None], 30),
    ],
)
def test_histogram_matches_numpy(spark, numbers, bins):
    got = explore.histogram(values(spark, numbers), "v", bins).orderBy("bin").collect()
    counts, edges = np.histogram([n for n in numbers if n is not None], bins=bins)
    assert [r.row_count for r in got] == list(counts)
    assert np.allclose([r.bin_start for r in got], edges[:-1])


def test_histogram_clips(spark):
    got = explore.histogram(values(spark, [-5, 0, 40, 80, 500]), "v", 4, clip_to=(0.0, 80.0))
    assert [r.row_count for r in got.orderBy("bin").collect()] == [2, 0, 1, 2]


@pytest.fixture(scope="module")
def clean(make_trips):
    hours = ["03", "09", "14", "20"]
    rows = [
        {
            "tpep_pickup_datetime": f"2023-0{1 + i % 3}-10 {hours[i % 4]}:00:00",
            "tpep_dropoff_datetime": f"2023-0{1 + i % 3}-10 {hours[i % 4]}:10:00",
            "source_month": f"2023-0{1 + i % 3}",
            "fare_amount": 10.0 + i,
            "tip_amount": 1.0 + (i % 5),
            "payment_type": 1 + i % 6,
            "dolocationid": 132 if i % 2 else 7,
            "total_amount": 20.0 + i,
        }
        for i in range(60)
    ]
    return cleaning.clean_trips(make_trips(*rows)).persist()


def test_summary_adds_up(clean):
    got = reports.trip_summary(clean)
    total = got.agg(F.sum("total_trips").alias("n"), F.sum("generous_tippers").alias("g")).first()
    assert total.n == 60
    assert total.g == clean.filter("generous_tipper = 1").count()
    plain = reports.trip_summary(clean, exact=False)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in plain.collect()]


def test_distribution_adds_up(clean):
    got = reports.distribution(clean, "time_of_day").collect()
    assert sum(r.row_count for r in got) == 60 and {r.pct for r in got} == {25.0}


def test_counts_where_in_one_pass(clean):
    frame = reports.counts_where(clean, airport=F.col("is_airport_trip") == 1, dear=F.col("fare_amount") > 60)
    assert tuple(frame.first()) == (60, 30, 9)


def test_reduction(make_trips):
    raw = make_trips({}, {"fare_amount": 1.0}, {"source_month": "2023-09", "tip_amount": None})
    kept = cleaning.clean_trips(raw, TripLimits(period=None))
    assert tuple(reports.reduction(raw, kept).first()) == (3, 1, 2, 66.7)
    got = {r.source_month: tuple(r)[1:] for r in reports.reduction_by(raw, kept).collect()}
    assert got == {"2023-03": (2, 1, 1, 50.0), "2023-09": (1, 0, 1, 100.0)}


def test_filters(clean):
    def n(**choice):
        return explore.apply_filters(clean, explore.Filters(**choice)).count()

    assert n() == 60
    assert n(months=("2023-01",)) == 20
    assert n(day_parts=("night", "evening")) == 30
    assert n(airport=True) == 30 and n(airport=False) == 30
    assert n(payment="Cash") == 10
    assert n(payment="5") == 10
    with pytest.raises(ValueError, match="unknown payment"):
        n(payment="Barter")


def test_key_figures_and_payments(clean):
    row = explore.key_figures(clean).first()
    assert row.trips == 60 and row.avg_fare == 39.5 and row.avg_duration_min == 10.0
    shown = {r.payment for r in explore.generous_by_payment(clean).collect()}
    assert shown == {"Credit Card", "Cash", "No Charge", "Dispute", "5", "6"}


def test_null_counts(make_trips):
    df = make_trips({"extra": None}, {"extra": None, "airport_fee": None}, {})
    row = profile.null_counts(df).first()
    assert (row.extra, row.airport_fee, row.fare_amount) == (2, 1, 0)


def test_numeric_summary(spark):
    got = profile.numeric_summary(values(spark, [1, 2, 3, 4, None]), ["v"], digits=6)
    assert {r.summary: r.v for r in got.collect()} == {
        "count": 4.0, "mean": 2.5, "stddev": 1.290994, "min": 1.0, "max": 4.0,
    }


def test_menu_values(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "x string")
    assert [r.x for r in profile.menu_values(df, "x").collect()] == ["a", "b"]


# --- samples -----------------------------------------------------------------


def hashed():
    from meterline.functions.hashing import row_hash

    return row_hash(["id"])


def test_fixed_size_is_exact_and_stable(spark):
    table = spark.range(20_000)
    one = {r.id for r in sampling.fixed_size(table, 777, hashed()).collect()}
    two = {r.id for r in sampling.fixed_size(table.repartition(13), 777, hashed()).collect()}
    assert len(one) == 777 and one == two
    least = {r.id for r in table.orderBy(hashed()).limit(777).collect()}
    assert one == least
    assert sampling.fixed_size(table, 50_000, hashed()).count() == 20_000


def test_fixed_size_with_a_third_of_the_rows_alike(spark):
    table = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id"))
    assert sampling.fixed_size(table, 1_000, hashed()).count() == 1_000


def test_split_is_disjoint_and_whole(spark):
    table = spark.range(10_000)
    train, test = sampling.train_test(table, keys=["id"])
    assert train.unionByName(test).distinct().count() == 10_000
    assert 7_800 < train.count() < 8_200 and train.count() + test.count() == 10_000
    again, _ = sampling.train_test(table.repartition(5), keys=["id"])
    assert again.exceptAll(train).count() == 0
    parts = sampling.split_by_hash(table, [1, 1, 2], hashed())
    assert sum(p.count() for p in parts) == 10_000


def test_bernoulli(spark):
    table = spark.range(10_000)
    assert 850 < sampling.bernoulli(table, 0.1, by=hashed()).count() < 1_150
    assert 850 < sampling.bernoulli(table, 0.1).count() < 1_150
    assert sum(p.count() for p in sampling.random_split(table, [0.8, 0.2])) == 10_000


def test_the_nth_hash_and_equal_rows(spark):
    """Ties at the last hash: as many of the equal rows as fit, in any layout; no task sorts all rows."""
    table = spark.range(5000).select((F.col("id") % 100).alias("k"), (F.col("id") % 3).alias("v"))
    by = hashing.row_hash(["k"])
    for n in (0, 1, 49, 50, 51, 1234, 4999, 5000, 6000):
        ways = [sorted(map(tuple, sampling.fixed_size(df, n, by).collect())) for df in (table, table.repartition(9))]
        assert ways[0] == ways[1] and len(ways[0]) == min(n, 5000)
    order = sorted(r[0] for r in table.select(by).collect())
    for n in (1, 50, 51, 5000):
        last, below = sampling.nth_hash(table, n, by)
        assert last == order[n - 1] and below == sum(h < last for h in order)
    assert sampling.nth_hash(table, 5001, by) is None and sampling.nth_hash(table.limit(0), 1, by) is None
