"""Filters, key figures and histograms of the trip explorer."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.numeric import clip, percent
from meterline.functions.text import decode, encode
from meterline.operators.reports import mean_from, sums_of
from meterline.schema import EXPLORER_PAYMENT_LABELS, LABEL, MONTH


@dataclass(frozen=True)
class Filters:
    """What the explorer shows. Anything left empty does not restrict the rows.

    A payment type is given by its label in the menu or by its number.
    """

    months: tuple[str, ...] = ()
    day_parts: tuple[str, ...] = ()
    airport: bool | None = None
    payment: str | None = None

    def condition(self) -> Column:
        terms = []
        if self.months:
            terms.append(F.col(MONTH).isin(*self.months))
        if self.day_parts:
            terms.append(F.col("time_of_day").isin(*self.day_parts))
        if self.airport is not None:
            terms.append(F.col("is_airport_trip") == int(self.airport))
        if self.payment is not None:
            terms.append(F.col("payment_type") == _payment_code(self.payment))
        return reduce(and_, terms, F.lit(True))


def _payment_code(choice: str) -> Column:
    if choice in EXPLORER_PAYMENT_LABELS.values():
        return encode(F.lit(choice), EXPLORER_PAYMENT_LABELS)
    if choice.isdecimal():
        return F.lit(int(choice))
    raise ValueError(f"unknown payment type: {choice}")


def apply_filters(trips: DataFrame, filters: Filters) -> DataFrame:
    return trips.filter(filters.condition())


def key_figures(trips: DataFrame, exact: bool = True) -> DataFrame:
    """One row: trips, average fare, tip, distance and duration, percent generous."""
    means = {"avg_fare": "fare_amount", "avg_tip": "tip_amount", "avg_distance": "trip_distance", "avg_duration_min": "trip_duration_min"}
    sums = sums_of(trips, [], [*means.values(), LABEL], exact)
    return sums.select(
        F.col("row_count").alias("trips"), *[mean_from(column).alias(name) for name, column in means.items()],
        (mean_from(LABEL) * 100).alias("pct_generous"),
    )


def trips_by_hour(trips: DataFrame) -> DataFrame:
    return trips.groupBy("pickup_hour").agg(F.count(F.lit(1)).alias("trips"))


def generous_by_payment(trips: DataFrame) -> DataFrame:
    """Percent of generous tippers by payment type, with the menu's labels."""
    return (
        trips.groupBy("payment_type")
        .agg(F.count(F.lit(1)).alias("trips"), F.sum(LABEL).alias("generous"))
        .select(
            decode(F.col("payment_type"), EXPLORER_PAYMENT_LABELS).alias("payment"),
            "trips",
            percent("generous", "trips").alias("pct_generous"),
        )
    )


def histogram(
    df: DataFrame, column: str, bins: int, clip_to: tuple[float, float] | None = None
) -> DataFrame:
    """Counts in equal bins from the least to the greatest value.

    A bin holds its lower edge but not its upper one, except that the last bin holds
    both. If all values are equal the range reaches half a unit to either side. Empty
    bins are there with a count of zero. The column is read twice: once for the range
    and once for the counts.
    """
    value = F.col(column) if clip_to is None else clip(column, *clip_to)
    values = df.select(value.cast("double").alias("x")).filter(F.col("x").isNotNull())
    least, most = F.min("x"), F.max("x")
    half = F.when(least == most, F.lit(0.5)).otherwise(F.lit(0.0))
    span = values.agg((least - half).alias("low"), (most + half).alias("high"))
    low, high = span.select("low").scalar(), span.select("high").scalar()

    width = (F.col("high") - F.col("low")) / F.lit(float(bins))
    ranged = values.withColumns({"low": low, "high": high}).withColumn("width", width)
    rough = F.least(F.floor((F.col("x") - F.col("low")) / F.col("width")), F.lit(bins - 1).cast("long"))
    placed = ranged.withColumn("bin", rough)
    below = F.col("x") < F.col("low") + F.col("bin") * F.col("width")
    above = (F.col("bin") < bins - 1) & (
        F.col("x") >= F.col("low") + (F.col("bin") + 1) * F.col("width")
    )
    settled = F.when(below, F.col("bin") - 1).when(above, F.col("bin") + 1).otherwise(F.col("bin"))
    counts = placed.groupBy(settled.alias("bin")).agg(F.count(F.lit(1)).alias("row_count"))

    # As many rows as there are bins, whatever the size of the table.
    spark = df.sparkSession
    edges = spark.range(bins).select(F.col("id").alias("bin"), low.alias("low"), high.alias("high"))
    return (
        edges.join(counts, "bin", "left")
        .withColumn("width", width)
        .select(
            (F.col("bin") + 1).alias("bin"),
            (F.col("low") + F.col("bin") * F.col("width")).alias("bin_start"),
            (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
            F.coalesce("row_count", F.lit(0).cast("long")).alias("row_count"),
        )
    )
