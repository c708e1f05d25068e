"""Connected components of a link table, by rounds of large and small stars.

Each round groups by node with a minimum (combined inside tasks first) and joins the
minimum back, so a hub is split like any other skewed join. Rounds are cut by tables in
the shared folder; the number of rounds grows with the logarithm of a component's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.scratch import fresh_path


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (hi, lo), hi > lo; returns edges of the same form."""
    if large:
        near = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
    else:
        near = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = near.join(least, "u")
    if large:
        return moved.filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
    kept = moved.filter("v > m").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    return kept.unionAll(least.select(F.col("u").alias("hi"), F.col("m").alias("lo"))).distinct()


def roots(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node with a link to another; root is the least node reachable."""
    spark = links.sparkSession
    edges = links.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    state = None
    while True:
        path = fresh_path(spark, "stars")
        edges.write.parquet(path)
        edges = spark.read.parquet(path)
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first()
        if now == state or now[0] == 0:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(
                edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
            )
        state = now
        edges = _stars(_stars(edges, large=True), large=False)
