"""Grouped reports over the clean table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.exact import exact_sums
from meterline.functions.numeric import percent
from meterline.schema import LABEL, MONTH


def _rows() -> Column:
    return F.count(F.lit(1))


def sums_of(df: DataFrame, keys: Sequence[str | Column], columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Keys, ``row_count``, and ``sum_`` and ``n_`` of each column: exact in any order, or by Spark's own ``sum``."""
    if exact:
        return exact_sums(df, keys, columns)
    sums = [x for c in columns for x in (F.sum(F.col(c).cast("double")).alias(f"sum_{c}"), F.count(c).alias(f"n_{c}"))]
    return df.groupBy(*keys).agg(_rows().alias("row_count"), *sums)


def mean_from(column: str, digits: int | None = None) -> Column:
    """The mean of a column from its sum and its number of values; null when there are none."""
    mean = F.try_divide(f"sum_{column}", f"n_{column}")
    return mean if digits is None else F.round(mean, digits)


SUMMARY_KEYS = (MONTH, "time_of_day", "is_airport_trip")
SUMMARY_MEANS = {
    "avg_fare": ("fare_amount", 2), "avg_tip": ("tip_amount", 2), "avg_distance": ("trip_distance", 2),
    "avg_duration_min": ("trip_duration_min", 2), "avg_tip_pct": ("tip_pct", 4), "generous_tipper_rate": (LABEL, 3),
}
SUMMARY_COLUMNS = tuple(column for column, _ in SUMMARY_MEANS.values())


def summary_from(sums: DataFrame) -> DataFrame:
    """The trip summary from sums by its keys."""
    return sums.select(
        *SUMMARY_KEYS, F.col("row_count").alias("total_trips"), *[mean_from(*of).alias(name) for name, of in SUMMARY_MEANS.items()],
        F.col(f"sum_{LABEL}").cast("long").alias("generous_tippers"),
    ).orderBy(*SUMMARY_KEYS)


def trip_summary(trips: DataFrame, exact: bool = True) -> DataFrame:
    """Trips, averages and generous tippers by month, part of the day and airport flag."""
    return summary_from(sums_of(trips, SUMMARY_KEYS, SUMMARY_COLUMNS, exact))


def group_sizes(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Rows per group."""
    return df.groupBy(*keys).agg(_rows().alias("row_count"))


def tip_share_by(trips: DataFrame, key: str, digits: int | None = None, exact: bool = True) -> DataFrame:
    """Trips and average tip share by one column, in its order."""
    sums = sums_of(trips, [key], ["tip_pct"], exact)
    return sums.select(key, F.col("row_count").alias("trips"), mean_from("tip_pct", digits).alias("avg_tip_pct")).orderBy(key)


def fare_by(trips: DataFrame, *keys: str, digits: int | None = None, exact: bool = True) -> DataFrame:
    """Trips and average fare by the given columns."""
    sums = sums_of(trips, keys, ["fare_amount"], exact)
    return sums.select(*keys, F.col("row_count").alias("trips"), mean_from("fare_amount", digits).alias("avg_fare"))


def overall_mean(df: DataFrame, column: str, exact: bool = True) -> DataFrame:
    return sums_of(df, [], [column], exact).select(mean_from(column).alias(f"avg_{column}"))


def counts_where(df: DataFrame, **conditions: Column) -> DataFrame:
    """How many rows meet each condition, all in one pass."""
    return df.agg(
        _rows().alias("total"), *[F.count_if(c).alias(name) for name, c in conditions.items()]
    )


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value and their share in percent; nulls form a group of their own."""
    sizes = df.groupBy(column).agg(_rows().alias("row_count"))
    total = sizes.agg(F.sum("row_count").alias("total"))
    return sizes.withColumn("pct", percent("row_count", total.scalar()))


def reduction(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Rows before and after cleaning, how many went, and their share in percent."""
    before = raw.agg(_rows().alias("raw_rows"))
    after = clean.agg(_rows().alias("clean_rows"))
    both = before.withColumn("clean_rows", after.scalar())
    return _with_removed(both)


def reduction_by(raw: DataFrame, clean: DataFrame, key: str = MONTH) -> DataFrame:
    """The same for each value of ``key``, null included: both tables counted, then put together."""
    before = raw.groupBy(key).agg(_rows().alias("raw_rows"), F.lit(0).cast("long").alias("clean_rows"))
    after = clean.groupBy(key).agg(F.lit(0).cast("long").alias("raw_rows"), _rows().alias("clean_rows"))
    both = before.unionByName(after).groupBy(key)
    return _with_removed(both.agg(F.sum("raw_rows").alias("raw_rows"), F.sum("clean_rows").alias("clean_rows")))


def _with_removed(counts: DataFrame) -> DataFrame:
    removed = F.col("raw_rows") - F.col("clean_rows")
    return counts.withColumns(
        {"removed_rows": removed, "removed_pct": percent(removed, "raw_rows")}
    )
