"""Fixed names, thresholds and defaults of the trip tables."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values: column names and their types ------------------------------

# Identifier and code columns; raw files hold them as int, long or double.
LONG_COLUMNS = (
    "vendorid",
    "pulocationid",
    "dolocationid",
    "payment_type",
    "ratecodeid",
    "passenger_count",
)

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
MONTH = "source_month"
LABEL = "generous_tipper"

# The clean table: 28 columns, in this order.
CLEAN_COLUMNS = (
    "source_month",
    "vendorid",
    "passenger_count",
    "trip_distance",
    "ratecodeid",
    "store_and_fwd_flag",
    "payment_type",
    "pulocationid",
    "dolocationid",
    "is_airport_trip",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
    "total_amount",
    "trip_duration_min",
    "pickup_hour",
    "pickup_dayofweek",
    "is_weekend",
    "time_of_day",
    "avg_speed_mph",
    "tip_pct",
    "fare_per_mile",
    "generous_tipper",
)

# Columns that give the label away, plus the audit column.
LEAKAGE_COLUMNS = ("tip_amount", "tip_pct", "total_amount", "fare_per_mile", "source_month")

CATEGORICAL_FEATURES = ("time_of_day", "store_and_fwd_flag")

NUMERIC_FEATURES = (
    "vendorid",
    "passenger_count",
    "trip_distance",
    "ratecodeid",
    "payment_type",
    "pulocationid",
    "dolocationid",
    "is_airport_trip",
    "fare_amount",
    "extra",
    "mta_tax",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
    "trip_duration_min",
    "pickup_hour",
    "pickup_dayofweek",
    "is_weekend",
    "avg_speed_mph",
)

FARE_TARGET = "fare_amount"

FARE_FEATURES = (
    "trip_distance",
    "trip_duration_min",
    "pickup_hour",
    "pickup_dayofweek",
    "is_weekend",
    "is_airport_trip",
    "passenger_count",
    "pulocationid",
    "dolocationid",
    "avg_speed_mph",
)

# --- Fixed values: codes and defaults ----------------------------------------

AIRPORT_ZONES = (1, 132, 138)

# Last hour of each part of the day; later hours are "evening".
DAY_PARTS = ((5, "night"), (11, "morning"), (17, "afternoon"))
LAST_DAY_PART = "evening"

PAYMENT_LABELS = {
    1: "Credit Card",
    2: "Cash",
    3: "No Charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided",
}

# The explorer menus name only these codes; other codes show as plain numbers.
EXPLORER_PAYMENT_LABELS = {1: "Credit Card", 2: "Cash", 3: "No Charge", 4: "Dispute"}

NULL_DEFAULTS = {
    "passenger_count": 1,
    "ratecodeid": 1,
    "congestion_surcharge": 2.5,
    "airport_fee": 0.0,
    "store_and_fwd_flag": "N",
}

# Values a scoring request takes when it leaves a field out.
REQUEST_DEFAULTS = {
    "passenger_count": 1,
    "is_airport_trip": 0,
    "ratecodeid": 1,
    "pulocationid": 161,
    "dolocationid": 132,
    "congestion_surcharge": 2.5,
}

# Features a scoring request never carries.
REQUEST_CONSTANTS = {
    "mta_tax": 0.5,
    "improvement_surcharge": 1.0,
    "extra": 0.5,
    "tolls_amount": 0.0,
    "store_and_fwd_flag": "N",
    "vendorid": 1,
    "airport_fee": 0.0,
}

# --- Fixed values: thresholds -------------------------------------------------


@dataclass(frozen=True)
class TripLimits:
    """Bounds of a valid trip. ``period`` is a half-open range of pickup days."""

    fare: tuple[float, float] = (2.50, 500.0)
    distance: tuple[float, float] = (0.01, 100.0)
    duration_min: tuple[float, float] = (0.5, 180.0)
    top_speed_mph: float = 100.0
    payment_codes: tuple[int, ...] = (1, 2, 3, 4, 5, 6)
    period: tuple[str, str] | None = ("2023-01-01", "2024-01-01")


@dataclass(frozen=True)
class RequestLimits:
    """Bounds of a scoring request; both ends count unless named ``above``."""

    codes: dict[str, tuple[int, int]] = field(
        default_factory=lambda: {
            "payment_type": (1, 6),
            "pickup_hour": (0, 23),
            "pickup_dayofweek": (1, 7),
            "passenger_count": (1, 6),
            "is_airport_trip": (0, 1),
            "ratecodeid": (1, 6),
            "pulocationid": (1, 265),
            "dolocationid": (1, 265),
        }
    )
    distance_above: float = 0.0
    distance_most: float = 100.0
    fare: tuple[float, float] = (2.5, 500.0)
    duration_above: float = 0.0
    duration_most: float = 180.0
    congestion_least: float = 0.0
    top_speed_mph: float = 100.0


GENEROUS_ABOVE = 0.20
