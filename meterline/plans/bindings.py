"""Trip-shaped views over order tables, so that the operators have something to run on.

Order lines become trips: the order date plus a time of day gives the pickup, price and
quantity give fare and distance, and so on. Every order line is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.schema import DROPOFF, MONTH, PICKUP, TripLimits

# The order tables span several years, so no period rule unless a query asks for one.
ANY_PERIOD = TripLimits(period=None)
ONE_YEAR = TripLimits(period=("1998-01-01", "1999-01-01"))

# Identify a trip of the view.
TRIP_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_CLOCK = "l_orderkey * 7919 % 86400"
_FARE = "l_extendedprice / 200"
_TIP = f"({_FARE}) * (l_discount - 0.005D) * 3"
_TOLLS = "l_tax * 100"

_TRIP = [
    *TRIP_KEYS,
    f"timestampadd(SECOND, {_CLOCK}, o_orderdate) AS {PICKUP}",
    f"timestampadd(SECOND, {_CLOCK} + l_partkey * 37 % 12000 - 300, o_orderdate) AS {DROPOFF}",
    "l_suppkey % 2 + 1 AS vendorid",
    "l_suppkey % 8 AS payment_type",
    "IF(l_partkey % 10 = 0, NULL, CAST(l_linenumber AS BIGINT)) AS passenger_count",
    "IF(l_partkey % 11 = 0, NULL, CAST(l_linenumber % 6 + 1 AS BIGINT)) AS ratecodeid",
    "CASE WHEN l_partkey % 13 = 0 THEN NULL WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END"
    " AS store_and_fwd_flag",
    "IF(l_partkey % 7 = 0, NULL, 2.5D) AS congestion_surcharge",
    "IF(l_partkey % 9 = 0, NULL, CAST(l_suppkey % 2 AS DOUBLE)) AS airport_fee",
    "l_partkey % 265 + 1 AS pulocationid",
    "l_suppkey % 265 + 1 AS dolocationid",
    "l_quantity * 2.1D AS trip_distance",
    f"{_FARE} AS fare_amount",
    f"{_TIP} AS tip_amount",
    f"{_TOLLS} AS tolls_amount",
    "0.5D AS mta_tax",
    "1.0D AS improvement_surcharge",
    "CAST(l_linenumber % 3 AS DOUBLE) AS extra",
    # The clock never passes midnight, so the order date tells the month of the pickup.
    f"left(CAST(CAST(o_orderdate AS DATE) AS STRING), 7) AS {MONTH}",
    f"{_FARE} + {_TIP} + {_TOLLS} - 10.0D AS total_amount",
]


# Order lines that one task is to hold, and how many of such shares a table needs to be laid out by them.
LINES_A_TASK = 250_000
LEAST_TASKS = 8


def by_order(lines: DataFrame) -> DataFrame:
    """Order lines in as many tasks as their number asks for, all lines of an order in one.

    A split of a file holds as many rows as its compression allows, and shuffles have a fixed
    number of partitions, so what tasks hold to find copies would grow with the table. The
    rows are counted from the footers. Tables of few lines stay as they are.
    """
    tasks = -(-lines.count() // LINES_A_TASK)
    return lines.repartition(tasks, "l_orderkey") if tasks > LEAST_TASKS else lines


def trips(spark: SparkSession, folder: str) -> DataFrame:
    """One trip per order line.

    The join is left to Spark: it broadcasts the orders while they are small by its own
    size estimate, and beyond that sorts and merges. Trips of many lines come laid out by order, so
    neither the join nor finding copies shuffles them again; an order of very many lines
    stays in one task, which spills.
    """
    lines, orders = by_order(table(spark, folder, "lineitem")), table(spark, folder, "orders")
    joined = lines.join(
        orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return joined.selectExpr(*_TRIP)
