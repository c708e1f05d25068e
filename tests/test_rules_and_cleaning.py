from __future__ import annotations

import pytest
from compare import plan_text
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from meterline.operators import cleaning, rules
from meterline.schema import CLEAN_COLUMNS, TripLimits

ANY = TripLimits(period=None)


def kept(df, chosen, column):
    return [r[0] for r in rules.keep_valid(df, chosen).select(column).collect()]


@pytest.mark.parametrize(
    "column, values, good",
    [
        ("fare_amount", [2.49, 2.50, 500.0, 500.01, None], [2.50, 500.0]),
        ("trip_distance", [0.009, 0.01, 100.0, 100.01, None], [0.01, 100.0]),
        ("tip_amount", [-0.01, 0.0, None], [0.0]),
        ("total_amount", [0.0, 0.01, None], [0.01]),
        ("payment_type", [None, 0, 1, 6, 7], [1, 6]),
    ],
)
def test_bounds(make_trips, column, values, good):
    df = make_trips(*[{column: v} for v in values])
    assert kept(df, rules.trip_rules(), column) == good


def test_dropoff_has_to_be_later(make_trips):
    df = make_trips(
        {"tpep_dropoff_datetime": "2023-03-15 14:00:00"},
        {"tpep_dropoff_datetime": "2023-03-15 14:00:01"},
    )
    assert rules.keep_valid(df, rules.trip_rules()).count() == 1


def test_period(make_trips):
    stamps = ["2022-12-31 23:59:59", "2023-01-01 00:00:00", "2023-12-31 23:59:59", "2024-01-01 00:00:00"]
    df = make_trips(
        *[{"tpep_pickup_datetime": s, "tpep_dropoff_datetime": "2024-02-01 00:00:00"} for s in stamps]
    )
    assert rules.keep_valid(df, rules.trip_rules()).count() == 2
    assert rules.keep_valid(df, rules.trip_rules(ANY)).count() == 4


def test_duration_and_speed(make_trips):
    df = make_trips(
        {"tpep_dropoff_datetime": "2023-03-15 14:00:29", "trip_distance": 0.1},  # 0.48 min
        {"tpep_dropoff_datetime": "2023-03-15 14:00:30", "trip_distance": 0.1},  # 0.50 min
        {"tpep_dropoff_datetime": "2023-03-15 17:00:00"},  # 180 min
        {"tpep_dropoff_datetime": "2023-03-15 17:00:01"},  # 180.02 min
        {"tpep_dropoff_datetime": "2023-03-15 15:00:00", "trip_distance": 100.0},  # 100 mph
        {"tpep_dropoff_datetime": "2023-03-15 14:30:00", "trip_distance": 50.01},  # 100.02 mph
        {"tpep_dropoff_datetime": "2023-03-15 14:00:00"},  # no time at all
    )
    got = cleaning.derive_trips(df, ANY).select("trip_duration_min", "avg_speed_mph").collect()
    assert [tuple(r) for r in got] == [(0.5, 12.0), (180.0, 0.67), (60.0, 100.0)]


def test_derived_columns(make_trips):
    row = cleaning.clean_trips(make_trips({"dolocationid": 132})).first()
    assert (row.trip_duration_min, row.pickup_hour, row.pickup_dayofweek) == (10.0, 14, 4)
    assert (row.is_weekend, row.time_of_day, row.is_airport_trip) == (0, "afternoon", 1)
    assert (row.avg_speed_mph, row.tip_pct, row.fare_per_mile) == (12.0, 0.3, 5.0)
    assert row.generous_tipper == 1


def test_clean_table_has_its_columns_in_order(make_trips):
    clean = cleaning.clean_trips(make_trips())
    assert tuple(clean.columns) == CLEAN_COLUMNS and len(CLEAN_COLUMNS) == 28
    kinds = dict(clean.dtypes)
    assert kinds["generous_tipper"] == "int" and kinds["passenger_count"] == "bigint"


def test_defaults(make_trips):
    names = ["passenger_count", "ratecodeid", "congestion_surcharge", "airport_fee", "store_and_fwd_flag"]
    df = make_trips({n: None for n in names}, {"fare_amount": None})
    clean = cleaning.clean_trips(df)
    assert [tuple(r) for r in clean.select(*names).collect()] == [(1, 1, 2.5, 0.0, "N")]
    with pytest.raises(AnalysisException):
        cleaning.fill_defaults(df.drop("airport_fee")).count()


def test_copies(make_trips):
    df = make_trips({}, {}, {"source_month": "2023-04"})
    assert cleaning.clean_trips(df).count() == 2
    assert cleaning.clean_trips(df, copies=True).count() == 3


def test_order_of_dedup_and_filter_does_not_matter(make_trips):
    df = make_trips({}, {}, {"fare_amount": 1.0}, {"fare_amount": 1.0}, {"tip_amount": 0.0})
    chosen = rules.trip_rules()
    first = rules.keep_valid(cleaning.drop_copies(df), chosen)
    second = cleaning.drop_copies(rules.keep_valid(df, chosen))
    assert sorted(first.collect()) == sorted(second.collect())
    again = rules.keep_valid(second, chosen)
    assert sorted(again.collect()) == sorted(second.collect())


def test_audit_counts_nulls_as_failures(make_trips):
    df = make_trips({}, {"fare_amount": None}, {"fare_amount": 1.0, "tip_amount": -1.0})
    got = {r.rule: (r.rows_total, r.rows_failed) for r in rules.audit(df, rules.trip_rules()).collect()}
    assert got["fare_in_range"] == (3, 2) and got["tip_not_negative"] == (3, 1)
    assert got["pickup_in_period"] == (3, 0) and len(got) == 7


def test_first_failure_covers_every_row(make_trips):
    df = make_trips({}, {"fare_amount": None}, {"fare_amount": 1.0, "tip_amount": -1.0}, {"tip_amount": -1.0})
    got = {r.rule: r.row_count for r in rules.first_failure(df, rules.trip_rules()).collect()}
    assert got == {"accepted": 1, "fare_in_range": 2, "tip_not_negative": 1}


REQUEST = {
    "payment_type": 1, "trip_distance": 3.5, "fare_amount": 15.0, "trip_duration_min": 18.0,
    "pickup_hour": 18, "pickup_dayofweek": 6,
}


def violations(spark, **changes):
    from meterline.sources.readers import requests_table

    table = rules.with_request_defaults(requests_table(spark, [{**REQUEST, **changes}]))
    return rules.tag_violations(table, rules.request_rules()).first().violations


def test_request_rules(spark):
    assert violations(spark) == []
    assert violations(spark, payment_type=7) == ["payment_type"]
    assert violations(spark, payment_type=None) == ["payment_type"]
    assert violations(spark, trip_distance=0.0) == ["trip_distance"]
    assert violations(spark, passenger_count=None) == []
    assert violations(spark, passenger_count=7, pickup_hour=24) == ["pickup_hour", "passenger_count"]
    assert violations(spark, congestion_surcharge=-1.0) == ["congestion_surcharge"]
    # 90 miles in 30 minutes; but without a valid distance there is no speed to judge
    assert violations(spark, trip_distance=90.0, trip_duration_min=30.0) == ["average_speed"]
    assert violations(spark, trip_distance=190.0, trip_duration_min=30.0) == ["trip_distance"]


def test_quarantine_splits_without_loss(spark, make_trips):
    df = make_trips({}, {"fare_amount": 1.0}, {"tip_amount": None}, {"payment_type": 9})
    valid, rejected = rules.quarantine(df, rules.trip_rules())
    assert valid.count() == 1 and rejected.count() == 3
    both = valid.unionByName(rejected.drop("violations"))
    assert sorted(map(str, both.collect())) == sorted(map(str, df.collect()))


def test_optional_rules_are_off_by_default(make_trips):
    df = make_trips({"passenger_count": 9}, {"payment_type": 2})
    assert cleaning.clean_trips(df).count() == 2
    assert rules.keep_valid(df, rules.optional_trip_rules()).count() == 0


def test_leakage_and_fare_inputs(make_trips):
    clean = cleaning.clean_trips(make_trips())
    left = cleaning.without_leakage(clean).columns
    assert len(left) == 23 and not {"tip_amount", "tip_pct", "total_amount"} & set(left)
    assert len(cleaning.fare_inputs(clean).columns) == 11


def test_filters_reach_the_scan(spark, make_trips, tmp_path):
    make_trips().write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    clean = cleaning.clean_trips(raw).groupBy("time_of_day").agg(F.avg("tip_pct"))
    plan = plan_text(clean)
    for pushed in ("GreaterThanOrEqual(fare_amount,2.5)", "GreaterThanOrEqual(tpep_pickup_datetime"):
        assert pushed in plan
    assert "Python" not in plan
    # without looking for copies only the columns in use are read
    lean = cleaning.clean_rows(raw, copies=True).groupBy("time_of_day").agg(F.avg("tip_pct"))
    schema = plan_text(lean).split("ReadSchema: ")[1].splitlines()[0]
    assert "congestion_surcharge" not in schema and "extra" not in schema


def test_one_pass_sorts_out_and_counts(spark, make_trips, tmp_path):
    """The same rows and counts as the separate passes; nulls, an empty table, and rows of several months."""
    rows = make_trips({}, {"fare_amount": -1.0}, {"fare_amount": None, "tip_amount": -2.0}, {"payment_type": 9}, {"source_month": None}, {"source_month": "2023-04"})
    named = rules.trip_rules()
    done = rules.sort_out(rows, named, str(tmp_path / "a"), ["source_month"])
    valid, rejected = rules.quarantine(rows, named)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(done.valid) == key(valid) and key(done.rejected) == key(rejected.select(*done.rejected.columns))
    assert key(done.audit) == key(rules.audit(rows, named).select(*done.audit.columns))
    none = rules.sort_out(rows.limit(0), named, str(tmp_path / "b"))
    assert none.valid.count() == none.rejected.count() == 0 and {r.rows_failed for r in none.audit.collect()} == {0}
