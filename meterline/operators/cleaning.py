"""From raw trips to the clean table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.temporal import day_part, elapsed_minutes, weekend_flag
from meterline.functions.trip import (
    airport_flag,
    fare_per_mile,
    generous_flag,
    speed_mph,
    tip_share,
)
from meterline.operators.rules import keep_valid, physics_rules, trip_rules
from meterline.schema import (
    CLEAN_COLUMNS,
    DROPOFF,
    FARE_FEATURES,
    FARE_TARGET,
    LABEL,
    LEAKAGE_COLUMNS,
    NULL_DEFAULTS,
    PICKUP,
    TripLimits,
)


def drop_copies(df: DataFrame) -> DataFrame:
    """One row out of every group of identical rows.

    Copies collapse before the shuffle, so a large group of them costs one row per task.
    """
    return df.dropDuplicates()


def fill_defaults(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Replace nulls column by column. Naming a column the table lacks is an error."""
    return df.fillna(NULL_DEFAULTS if defaults is None else defaults)


def add_features(df: DataFrame) -> DataFrame:
    """Duration, clock, place, speed and tip columns, and the label."""
    hour, weekday = f"hour({PICKUP})", f"dayofweek({PICKUP})"
    return df.withColumns(
        {
            "trip_duration_min": elapsed_minutes(PICKUP, DROPOFF),
            "pickup_hour": F.expr(hour),
            "pickup_dayofweek": F.expr(weekday),
            "is_weekend": weekend_flag(weekday),
            "time_of_day": day_part(hour),
            "avg_speed_mph": speed_mph(),
            "tip_pct": tip_share(),
            "is_airport_trip": airport_flag(),
            "fare_per_mile": fare_per_mile(),
            LABEL: generous_flag(tip_share()),
        }
    )


def derive_trips(df: DataFrame, limits: TripLimits = TripLimits()) -> DataFrame:
    """Add the features, then drop trips of impossible duration or speed."""
    return add_features(keep_valid(df, physics_rules(limits)))


def clean_columns(df: DataFrame) -> DataFrame:
    """The 28 columns of the clean table, in order."""
    return df.select(*CLEAN_COLUMNS)


def without_leakage(df: DataFrame) -> DataFrame:
    """Leave out what gives the label away."""
    return df.drop(*LEAKAGE_COLUMNS)


def fare_inputs(df: DataFrame) -> DataFrame:
    """Inputs and target of the fare model, complete rows only."""
    return df.select(*FARE_FEATURES, FARE_TARGET).dropna()


def kept_rows(raw: DataFrame, limits: TripLimits = TripLimits(), copies: bool = False) -> DataFrame:
    """Valid trips, one of identical ones, as they came.

    All rules come before the shuffle that drops copies: they look at one row each,
    so the order does not change the result, only how much is shuffled. ``copies``
    keeps identical rows, which saves that shuffle where there are none.
    """
    valid = keep_valid(raw, [*trip_rules(limits), *physics_rules(limits)])
    return valid if copies else drop_copies(valid)


def finished(kept: DataFrame) -> DataFrame:
    """Kept trips with defaults and features; each row follows from itself alone."""
    return add_features(fill_defaults(kept))


def clean_rows(raw: DataFrame, limits: TripLimits = TripLimits(), copies: bool = False) -> DataFrame:
    """Valid trips with defaults and features, all columns kept."""
    return finished(kept_rows(raw, limits, copies))


def clean_trips(raw: DataFrame, limits: TripLimits = TripLimits(), copies: bool = False) -> DataFrame:
    """The clean table."""
    return clean_columns(clean_rows(raw, limits, copies))
