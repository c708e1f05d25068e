"""Score whole tables of trips or requests, by rules or by a fitted model."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Literal

from pyspark.ml import Model, PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.numeric import hit
from meterline.functions.temporal import day_part, weekend_flag
from meterline.functions.text import decision_text, decode, percent_text
from meterline.functions.trip import speed_from_minutes
from meterline.functions.vectors import class_confidence, likeness
from meterline.operators.reports import mean_from, sums_of
from meterline.schema import LABEL, PAYMENT_LABELS, REQUEST_CONSTANTS

# --- Fixed values: the rule score --------------------------------------------

CASH, CARD = 2, 1
CASH_SCORE = 0.06
OTHER_SCORE = 0.50
CARD_BASE = 0.72
AIRPORT_BONUS = 0.08
HOUR_BONUS = 0.04
DISTANCE_BONUS, DISTANCE_ABOVE = 0.03, 5
FARE_BONUS, FARE_ABOVE = 0.03, 20
SCORE_CAP = 0.97
DECISION_AT = 0.5

EVENING_HOURS = tuple(range(18, 24))
EVENING_AND_NIGHT_HOURS = EVENING_HOURS + tuple(range(0, 6))

MODEL_METHOD = "spark_model"
RULES_METHOD = "rule_based_fallback"


@dataclass(frozen=True)
class RuleScore:
    """Rule-based confidence as a column.

    ``bonus_hours`` are the pickup hours that raise a card payer's score.
    """

    bonus_hours: tuple[int, ...] = EVENING_HOURS

    def confidence(self) -> Column:
        def bonus(condition: Column, points: float) -> Column:
            return F.when(condition, F.lit(points)).otherwise(F.lit(0.0))

        card = (
            F.lit(CARD_BASE)
            + bonus(F.col("is_airport_trip") != 0, AIRPORT_BONUS)
            + bonus(F.col("pickup_hour").isin(*self.bonus_hours), HOUR_BONUS)
            + bonus(F.col("trip_distance") > DISTANCE_ABOVE, DISTANCE_BONUS)
            + bonus(F.col("fare_amount") > FARE_ABOVE, FARE_BONUS)
        )
        payment = F.col("payment_type")
        return (
            F.when(payment == CASH, F.lit(CASH_SCORE))
            .when(payment == CARD, F.least(F.round(card, 4), F.lit(SCORE_CAP)))
            .otherwise(F.lit(OTHER_SCORE))
        )


def score_by_rules(df: DataFrame, rule: RuleScore = RuleScore()) -> DataFrame:
    """Add ``prediction``, ``confidence`` and ``inference_method``."""
    decision = F.when(F.col("confidence") >= DECISION_AT, 1.0).otherwise(0.0)
    return df.withColumn("confidence", rule.confidence()).withColumns(
        {"prediction": decision, "inference_method": F.lit(RULES_METHOD)}
    )


def request_features(requests: DataFrame) -> DataFrame:
    """Every input the feature stages need, from the few fields of a request."""
    present = set(requests.columns)
    filled = {name: F.lit(v) for name, v in REQUEST_CONSTANTS.items() if name not in present}
    if LABEL not in present:
        filled[LABEL] = F.lit(0)  # the model does not look at it
    return requests.withColumns(
        {
            **filled,
            "is_weekend": weekend_flag("pickup_dayofweek"),
            "avg_speed_mph": speed_from_minutes("trip_distance", "trip_duration_min"),
            "time_of_day": day_part("pickup_hour"),
        }
    )


def score_by_model(features: DataFrame, model: Model, digits: int | None = 4) -> DataFrame:
    """Add the model's ``prediction``, ``confidence`` and ``inference_method``.

    A copy scores: a model fresh from training holds its training summary, and with it the
    session, which cannot go to the tasks once any table of the session was observed.
    """
    return model.copy().transform(features).withColumns(
        {
            "confidence": class_confidence(digits=digits),
            "inference_method": F.lit(MODEL_METHOD),
        }
    )


def gathered(vectors: DataFrame, column: str = "features") -> DataFrame:
    """The rows of each task with similar vectors next to each other.

    Neighbours take the same way down most trees, which the processor then has at hand.
    """
    keyed = vectors.withColumn("_likeness", likeness(column))
    return keyed.sortWithinPartitions("_likeness").drop("_likeness")


def score_requests(
    requests: DataFrame,
    scorer: Literal["model", "rules"] = "rules",
    stages: PipelineModel | None = None,
    model: Model | None = None,
    rule: RuleScore = RuleScore(),
    gather: bool = False,
) -> DataFrame:
    """Score valid requests. Asking for a model that is not there is an error.

    With ``gather`` a model gets similar requests of a task one after the other: large tables
    are scored sooner, but rows leave a task in another order.
    """
    expanded = request_features(requests)
    if scorer == "rules":
        return score_by_rules(expanded, rule)
    if stages is None or model is None:
        raise ValueError("scoring by model needs the feature stages and the model")
    vectors = stages.transform(expanded)
    return score_by_model(gathered(vectors) if gather else vectors, model, digits=None)


def responses(scored: DataFrame, *keep: str) -> DataFrame:
    """The answer to each scored request: decision, confidence and what was asked."""
    confidence = F.col("confidence")
    return scored.select(
        *keep,
        F.col("prediction").cast("int").alias("prediction"),
        decision_text(F.col("prediction")).alias("prediction_label"),
        F.round(confidence, 4).alias("confidence"),
        percent_text(confidence).alias("confidence_pct"),
        "inference_method",
        decode(F.col("payment_type"), PAYMENT_LABELS).alias("payment"),
        F.col("trip_distance").alias("trip_distance_mi"),
        F.col("fare_amount").alias("fare_amount_usd"),
        F.col("trip_duration_min").alias("duration_min"),
        "pickup_hour",
        "time_of_day",
        (F.col("is_airport_trip") != 0).alias("is_airport_trip"),
        (F.col("is_weekend") != 0).alias("is_weekend"),
    )


def prediction_summary(scored: DataFrame, label: str = LABEL, exact: bool = True) -> DataFrame:
    """One row: predictions, positive and negative ones, accuracy, mean confidence."""
    prediction, truth = F.col("prediction"), F.col(label).cast("double")
    marks = scored.select(
        "confidence", (prediction == 1.0).cast("int").alias("positive"), (prediction == 0.0).cast("int").alias("negative"), hit(prediction, truth).alias("right")
    )
    sums = sums_of(marks, [], ["confidence", "positive", "negative", "right"], exact)
    count = lambda name: F.coalesce(F.col(f"sum_{name}").cast("long"), F.lit(0).cast("long"))
    return sums.select(
        F.col("row_count").alias("total_predictions"), count("positive").alias("predicted_generous"),
        count("negative").alias("predicted_not_generous"), mean_from("right", 4).alias("accuracy"), mean_from("confidence", 4).alias("avg_confidence"),
    )


def prediction_figures(scored: DataFrame, exact: bool = True) -> DataFrame:
    """Percent predicted generous and mean confidence."""
    sums = sums_of(scored, [], ["prediction", "confidence"], exact)
    return sums.select(
        F.col("row_count").alias("predictions"), F.round(mean_from("prediction") * 100, 1).alias("pct_generous"),
        mean_from("confidence", 3).alias("avg_confidence"),
    )
