"""Columns derived from one trip."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterline.functions.numeric import ratio
from meterline.functions.temporal import elapsed_seconds
from meterline.schema import AIRPORT_ZONES, DROPOFF, GENEROUS_ABOVE, PICKUP


def speed_mph(
    distance: str = "trip_distance",
    start: str = PICKUP,
    end: str = DROPOFF,
    digits: int | None = 2,
) -> Column:
    """Average speed; null for a trip that takes no time."""
    return ratio(distance, f"({elapsed_seconds(start, end)}) / 3600D", digits)


def speed_from_minutes(distance: str, minutes: str) -> Column:
    """Average speed of a request, which gives its duration in minutes. Not rounded."""
    return ratio(distance, f"{minutes} / 60D")


def tip_share(tip: str = "tip_amount", fare: str = "fare_amount") -> Column:
    """Tip as a share of the fare, to four decimals."""
    return ratio(tip, fare, 4)


def fare_per_mile(fare: str = "fare_amount", distance: str = "trip_distance") -> Column:
    return ratio(fare, distance, 2)


def airport_flag(pickup_zone: str = "pulocationid", dropoff_zone: str = "dolocationid") -> Column:
    """1 where the trip starts or ends at an airport, else 0."""
    touches = F.col(pickup_zone).isin(*AIRPORT_ZONES) | F.col(dropoff_zone).isin(*AIRPORT_ZONES)
    return F.when(touches, 1).otherwise(0)


def generous_flag(share: Column) -> Column:
    """The label: 1 where the tip share is above the bar, else 0 (also for null)."""
    return F.when(share > GENEROUS_ABOVE, 1).otherwise(0)
