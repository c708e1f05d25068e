"""Profiles of a table: nulls, numeric summaries, menu values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.operators.reports import mean_from, sums_of


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with the number of nulls of every column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns or df.columns])


# Names of the rows of a numeric summary.
SUMMARY_ROWS = ("count", "mean", "stddev", "min", "max")


def numeric_summary(
    df: DataFrame, columns: Sequence[str], digits: int | None = None, exact: bool = True
) -> DataFrame:
    """Count, mean, sample deviation, least and greatest value, as numbers.

    One pass for the exact means, one for the rest.
    """
    means = sums_of(df, [], columns, exact).select(*[mean_from(c).alias(c) for c in columns])

    def measures(name: str) -> list[Column]:
        value = F.col(name)
        found = [
            F.count(value),
            means.select(name).scalar(),
            F.stddev_samp(value),
            F.min(value),
            F.max(value),
        ]
        found = [m.cast("double") for m in found]
        return found if digits is None else [F.round(m, digits) for m in found]

    wide = df.agg(*[F.array(*measures(name)).alias(name) for name in columns])
    labels = F.array(*[F.lit(s) for s in SUMMARY_ROWS])
    zipped = F.explode(F.arrays_zip(labels.alias("summary"), *[F.col(c) for c in columns]))
    return wide.select(zipped.alias("row")).select("row.*")


def menu_values(df: DataFrame, column: str) -> DataFrame:
    """The values a filter menu offers: distinct, not null, sorted."""
    return df.select(column).dropna().distinct().orderBy(column)
