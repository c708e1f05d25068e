"""Positions of categories by frequency, without the driver: for columns of any number of values.

The same order as Spark's ``StringIndexer`` with ``frequencyDesc``: the commonest first, equal
ones by their text. The indexer holds all categories on the driver; here they are counted and
sorted by ranges, and a position is the number of categories in the ranges before plus the
place in the own range. Only the sizes of the ranges meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterline.scratch import fresh_path

_RECORD_BITS = 33  # of monotonically_increasing_id, below the number of the task


def category_ranks(df: DataFrame, column: str) -> DataFrame:
    """(category, rows, position) of the values of a column, nulls left out."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, "categories")
    value = F.col(f"`{column}`").cast("string")
    counts = df.select(value.alias("category")).filter("category IS NOT NULL").groupBy("category").agg(F.count(F.lit(1)).alias("rows"))
    ordered = counts.repartitionByRange(F.col("rows").desc(), "category").sortWithinPartitions(F.col("rows").desc(), "category")
    # Written once, so that places within ranges are those of one sort.
    ordered.withColumn("place", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path).select(
        "category", "rows", F.shiftright("place", _RECORD_BITS).alias("range"), F.col("place").bitwiseAND(F.lit((1 << _RECORD_BITS) - 1)).alias("place")
    )
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    offsets = sizes.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return placed.join(offsets, "range").select("category", "rows", (F.col("before") + F.col("place")).alias("position"))


def with_positions(df: DataFrame, column: str, ranks: DataFrame, into: str, head: int | None = None, tail: int = 1) -> DataFrame:
    """Adds the position of a column's value; values without one, and nulls, get the last position.

    Only the ``head`` commonest categories keep a position of their own, if it is given; the
    others share ``tail`` positions behind them, by a hash. The last position is one more.
    """
    known = ranks.select(F.col("category").alias("_category"), F.col("position").alias("_position"))
    value = F.col(f"`{column}`").cast("string")
    joined = df.join(known, value == F.col("_category"), "left")
    if head is None:
        last = F.coalesce(ranks.agg(F.count(F.lit(1))).scalar(), F.lit(0))
        position = F.coalesce("_position", last)
    else:
        hashed = head + F.pmod(F.xxhash64("_category"), F.lit(tail))
        position = F.when(F.col("_position").isNull(), head + tail).when(F.col("_position") < head, F.col("_position")).otherwise(hashed)
    return joined.withColumn(into, position.cast("double")).drop("_category", "_position")
