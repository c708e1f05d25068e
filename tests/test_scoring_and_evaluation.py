from __future__ import annotations

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from meterline.operators import evaluation, rules, scoring
from meterline.sources.readers import requests_table

CARD = {
    "payment_type": 1, "trip_distance": 3.5, "fare_amount": 15.0, "trip_duration_min": 18.0,
    "pickup_hour": 18, "pickup_dayofweek": 6,
}


def answers(spark, *requests, rule=scoring.RuleScore()):
    table = rules.with_request_defaults(requests_table(spark, [{**CARD, **r} for r in requests]))
    scored = scoring.responses(scoring.score_requests(table, rule=rule))
    return [(r.prediction, r.confidence) for r in scored.collect()]


def test_rule_scores(spark):
    assert answers(
        spark,
        {},
        {"payment_type": 2},
        {"payment_type": 3},
        {"payment_type": 6},
        {"is_airport_trip": 1, "pickup_hour": 20, "trip_distance": 6.0, "fare_amount": 25.0},
        {"pickup_hour": 3},
    ) == [(1, 0.76), (0, 0.06), (1, 0.5), (1, 0.5), (1, 0.9), (1, 0.72)]
    night = scoring.RuleScore(scoring.EVENING_AND_NIGHT_HOURS)
    assert answers(spark, {"pickup_hour": 3}, {"pickup_hour": 12}, rule=night) == [(1, 0.76), (1, 0.72)]


def test_response_fields(spark):
    table = rules.with_request_defaults(requests_table(spark, [CARD]))
    row = scoring.responses(scoring.score_requests(table)).first()
    assert row.prediction_label == "Generous Tipper" and row.confidence_pct == "76.0%"
    assert row.payment == "Credit Card" and row.time_of_day == "evening"
    assert row.is_airport_trip is False and row.is_weekend is False
    assert row.inference_method == "rule_based_fallback"


def test_model_has_to_be_there(spark):
    with pytest.raises(ValueError, match="needs the feature stages"):
        scoring.score_requests(requests_table(spark, [CARD]), "model")


def scored(spark, rows):
    return spark.createDataFrame(rows, "generous_tipper int, prediction double, confidence double")


SOME = [(1, 1.0, 0.9), (1, 1.0, 0.8), (1, 0.0, 0.3), (0, 0.0, 0.2), (0, 1.0, 0.8), (0, 0.0, 0.1)]


def test_summaries(spark):
    row = scoring.prediction_summary(scored(spark, SOME)).first()
    assert tuple(row) == (6, 3, 3, 0.6667, 0.5167)
    assert tuple(scoring.prediction_figures(scored(spark, SOME)).first()) == (6, 50.0, 0.517)


def test_confusion_and_class_metrics(spark):
    table = scored(spark, SOME)
    cells = {(r[0], r[1]): r[2] for r in evaluation.confusion_matrix(table).collect()}
    assert cells == {(0, 0.0): 2, (0, 1.0): 1, (1, 0.0): 1, (1, 1.0): 2}
    one = evaluation.class_metrics(table).filter("generous_tipper = 1").first()
    assert tuple(one) == (1, 0.6667, 0.6667, 0.6667, 3, 0.6667)


@pytest.mark.parametrize("rows", [[(0, 0.0, 0.1)], [(1, 0.0, 0.1), (0, 0.0, 0.1)], [(1, 1.0, 0.9)]])
def test_missing_classes_give_zeros(spark, rows):
    table = scored(spark, rows)
    assert evaluation.confusion_matrix(table).count() == 4
    for row in evaluation.class_metrics(table).collect():
        assert None not in tuple(row)


def test_f1_from_rounded_or_not(spark):
    rows = [(1, 1.0, 1.0)] * 2 + [(0, 1.0, 1.0)] + [(1, 0.0, 0.0)] * 5 + [(0, 0.0, 0.0)] * 7
    for rounded in (True, False):
        row = evaluation.class_metrics(scored(spark, rows), f1_from_rounded=rounded).orderBy("generous_tipper").collect()[1]
        p, r = (round(2 / 3, 4), round(2 / 7, 4)) if rounded else (2 / 3, 2 / 7)
        assert row.f1 == pytest.approx(2 * p * r / (p + r), abs=5e-5)


def test_auc_is_exact(spark):
    frame = spark.range(5000).select(
        (F.abs(F.hash("id")) % 2).cast("int").alias("generous_tipper"),
        (F.abs(F.hash("id", F.lit(3))) % 700 / 700.0).alias("confidence"),
    ).withColumn("confidence", F.col("confidence") + F.col("generous_tipper") * 0.1).persist()
    judge = BinaryClassificationEvaluator(
        labelCol="generous_tipper", rawPredictionCol="confidence", numBins=0
    )
    got = evaluation.area_under_roc(frame, classes=16).first().auc
    assert got == pytest.approx(judge.evaluate(frame), abs=1e-12)
    third = frame.withColumn("confidence", F.when(F.rand(1) < 0.34, 0.5).otherwise(F.col("confidence"))).persist()
    assert evaluation.area_under_roc(third).first().auc == pytest.approx(judge.evaluate(third), abs=1e-12)


def test_auc_without_a_class_is_null(spark):
    assert evaluation.area_under_roc(scored(spark, [(1, 1.0, 0.4)])).first().auc is None
    assert evaluation.area_under_roc(scored(spark, SOME).limit(0)).first().auc is None


def test_regression_metrics_agree_with_the_evaluator(spark):
    frame = spark.range(500).select(
        (F.col("id") * 1.5 + 3).alias("y"), (F.col("id") * 1.4 + F.sin("id")).alias("prediction")
    )
    row = evaluation.regression_metrics(frame, "y").first()
    for name in ("rmse", "mae", "r2"):
        judge = RegressionEvaluator(labelCol="y", metricName=name)
        assert row[name] == pytest.approx(judge.evaluate(frame), rel=1e-9)
