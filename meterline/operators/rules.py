"""Named data-quality rules: filter by them, audit them, set violations apart."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from meterline.functions.numeric import rounds_into
from meterline.functions.temporal import elapsed_seconds, within_days
from meterline.functions.trip import speed_from_minutes
from meterline.operators.content import observed
from meterline.schema import DROPOFF, PICKUP, REQUEST_DEFAULTS, RequestLimits, TripLimits


@dataclass(frozen=True)
class Rule:
    """A condition a row has to meet. A condition that is null counts as not met.

    A rule with others in ``given`` is only judged on rows that meet those.
    """

    name: str
    holds: Column
    given: tuple[Rule, ...] = ()

    @property
    def fails(self) -> Column:
        broken = ~F.coalesce(self.holds, F.lit(False))
        for other in self.given:
            broken = F.coalesce(other.holds, F.lit(False)) & broken
        return broken


# --- The trip rules ----------------------------------------------------------


def trip_rules(limits: TripLimits = TripLimits()) -> list[Rule]:
    """Rules on columns of the raw table. Duration and speed are not among them."""
    rules = [
        Rule("fare_in_range", F.col("fare_amount").between(*limits.fare)),
        Rule("distance_in_range", F.col("trip_distance").between(*limits.distance)),
        Rule("tip_not_negative", F.col("tip_amount") >= 0),
        Rule("total_positive", F.col("total_amount") > 0),
        Rule("dropoff_after_pickup", F.col(DROPOFF) > F.col(PICKUP)),
        Rule("known_payment_code", F.col("payment_type").isin(*limits.payment_codes)),
    ]
    if limits.period is not None:
        rules.append(Rule("pickup_in_period", within_days(PICKUP, *limits.period)))
    return rules


def physics_rules(limits: TripLimits = TripLimits()) -> list[Rule]:
    """Rules on duration and speed, each to two decimals, from the raw columns."""
    seconds = elapsed_seconds(PICKUP, DROPOFF)
    minutes, speed = f"({seconds}) / 60D", f"try_divide(trip_distance, ({seconds}) / 3600D)"
    return [
        Rule("duration_in_range", rounds_into(minutes, *limits.duration_min, digits=2)),
        Rule("speed_possible", rounds_into(speed, None, limits.top_speed_mph, digits=2)),
    ]


def optional_trip_rules() -> list[Rule]:
    """Rules some users want on top; no job applies them by itself."""
    return [
        Rule("passengers_in_range", F.col("passenger_count").between(1, 6)),
        Rule("cash_without_tip", (F.col("payment_type") != 2) | (F.col("tip_amount") == 0)),
    ]


# --- The request rules -------------------------------------------------------


def with_request_defaults(requests: DataFrame) -> DataFrame:
    """Fill the optional fields that a request leaves out."""
    return requests.fillna(REQUEST_DEFAULTS)


def request_rules(limits: RequestLimits = RequestLimits()) -> list[Rule]:
    """Range rules per field, then the speed rule across two of them.

    Speed is only judged where distance and duration are valid by themselves.
    """
    rules = [
        Rule(name, F.col(name).between(low, high)) for name, (low, high) in limits.codes.items()
    ]
    distance = Rule(
        "trip_distance",
        (F.col("trip_distance") > limits.distance_above)
        & (F.col("trip_distance") <= limits.distance_most),
    )
    duration = Rule(
        "trip_duration_min",
        (F.col("trip_duration_min") > limits.duration_above)
        & (F.col("trip_duration_min") <= limits.duration_most),
    )
    speed = speed_from_minutes("trip_distance", "trip_duration_min")
    return [
        *rules,
        distance,
        duration,
        Rule("fare_amount", F.col("fare_amount").between(*limits.fare)),
        Rule("congestion_surcharge", F.col("congestion_surcharge") >= limits.congestion_least),
        Rule("average_speed", speed <= limits.top_speed_mph, given=(distance, duration)),
    ]


# --- Using rules -------------------------------------------------------------


def keep_valid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that meet every rule. The plain conjunction reaches the Parquet scan.

    Rules that others are ``given`` have to be in the list, so nothing else needs a look.
    """
    names = {r.name for r in rules}
    missing = sorted({g.name for r in rules for g in r.given} - names)
    if missing:
        raise ValueError(f"rules that others depend on are missing: {', '.join(missing)}")
    return df.filter(reduce(and_, [r.holds for r in rules]))


def audit(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Per rule, how many rows fail it, in one pass. Rows can fail several rules."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows_total"),
        *[F.count_if(r.fails).alias(r.name) for r in rules],
    )
    return counts.unpivot("rows_total", [r.name for r in rules], "rule", "rows_failed")


def first_failure(df: DataFrame, rules: Sequence[Rule], accepted: str = "accepted") -> DataFrame:
    """Per rule, how many rows fail it and none before it; ``accepted`` for the rest."""
    reason = F.coalesce(*[F.when(r.fails, F.lit(r.name)) for r in rules], F.lit(accepted))
    return df.groupBy(reason.alias("rule")).agg(F.count(F.lit(1)).alias("row_count"))


def tag_violations(df: DataFrame, rules: Sequence[Rule], into: str = "violations") -> DataFrame:
    """Add the names of the rules a row fails; an empty list for a valid row."""
    failed = F.array_compact(F.array(*[F.when(r.fails, F.lit(r.name)) for r in rules]))
    return df.withColumn(into, failed)


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with the names of the rules they fail."""
    rejected = tag_violations(df, rules).filter(F.size("violations") > 0)
    return keep_valid(df, rules), rejected


@dataclass(frozen=True)
class SortedOut:
    """What one pass over a table left: valid rows, rejected ones with the rules they fail, and the audit."""

    valid: DataFrame
    rejected: DataFrame
    audit: DataFrame


def sort_out(df: DataFrame, rules: Sequence[Rule], path: str, by: Sequence[str] = ()) -> SortedOut:
    """Write valid and rejected rows below ``path`` and count failures, all in one scan and one commit.

    Rows go to a folder for each outcome and, within it, for each value of ``by``. The counts
    are taken by the tasks that write, so a task that runs again does not count twice. The
    three results are those of :func:`quarantine` and :func:`audit`.
    """
    spark = df.sparkSession
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows_total"), *[F.count_if(F.array_contains("violations", r.name)).alias(r.name) for r in rules]]
    outcome = F.when(F.size("violations") == 0, "valid").otherwise("rejected")
    routed = tag_violations(df, rules).withColumn("outcome", outcome)
    routed.observe(seen, *counts).write.mode("overwrite").partitionBy("outcome", *by).parquet(path)
    back = spark.read.schema(routed.schema).parquet(path)
    told = observed(seen)
    rows = [(told.get("rows_total", 0), r.name, told.get(r.name, 0)) for r in rules]
    return SortedOut(
        back.filter("outcome = 'valid'").select(*[f"`{c}`" for c in df.columns]),
        back.filter("outcome = 'rejected'").select(*[f"`{c}`" for c in df.columns], "violations"),
        spark.createDataFrame(rows, "rows_total long, rule string, rows_failed long"),
    )
