from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("meterline-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


# One valid raw trip: 10 minutes, 2 miles, $10 fare, $3 tip, on a Wednesday afternoon.
TRIP = {
    "source_month": "2023-03",
    "vendorid": 1,
    "tpep_pickup_datetime": "2023-03-15 14:00:00",
    "tpep_dropoff_datetime": "2023-03-15 14:10:00",
    "passenger_count": 2,
    "trip_distance": 2.0,
    "ratecodeid": 1,
    "store_and_fwd_flag": "N",
    "payment_type": 1,
    "pulocationid": 100,
    "dolocationid": 200,
    "fare_amount": 10.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 3.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "congestion_surcharge": 2.5,
    "airport_fee": 0.0,
    "total_amount": 17.5,
}

TRIP_DDL = (
    "source_month string, vendorid long, tpep_pickup_datetime string, "
    "tpep_dropoff_datetime string, passenger_count long, trip_distance double, ratecodeid long, "
    "store_and_fwd_flag string, payment_type long, pulocationid long, dolocationid long, "
    "fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double, "
    "improvement_surcharge double, congestion_surcharge double, airport_fee double, "
    "total_amount double"
)


@pytest.fixture(scope="session")
def make_trips(spark):
    """Raw trips, each like TRIP but for the given fields."""

    def make(*changes: dict):
        rows = [tuple({**TRIP, **c}[name] for name in TRIP) for c in (changes or ({},))]
        frame = spark.createDataFrame(rows, TRIP_DDL)
        stamps = ("tpep_pickup_datetime", "tpep_dropoff_datetime")
        return frame.withColumns({c: frame[c].cast("timestamp_ntz") for c in stamps})

    return make
