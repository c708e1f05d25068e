"""Classifier, regressor, tuning, and tables about them."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators.cleaning import fare_inputs
from meterline.operators.evaluation import regression_metrics, weighted_metrics
from meterline.operators.sampling import bernoulli, train_test
from meterline.schema import FARE_FEATURES, FARE_TARGET, LABEL
from meterline.scratch import executor_memory

SEED = 42


@dataclass(frozen=True)
class ForestSettings:
    """Size of a random forest."""

    trees: int = 50
    depth: int = 8
    least_rows: int = 1


@dataclass(frozen=True)
class TuningGrid:
    """Values that cross-validation combines, and the share of rows it works on: all of them unless a caller asks for less."""

    trees: tuple[int, ...] = (30, 50)
    depths: tuple[int, ...] = (6, 10)
    least_rows: tuple[int, ...] = (1, 5)
    folds: int = 3
    sample: float = 1.0
    parallelism: int = 2


@contextmanager
def held(df: DataFrame):
    """Keep a table that several passes read in memory or on disk, and let it go after."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


# --- Classifier --------------------------------------------------------------

# What training holds of a row in any case, about, and of a row in each tree: how often the
# tree draws it, and twice the node it is in, before and after a level.
ROW_BYTES, TREE_BYTES = 232, 12


def remembers(rows: int, trees: int, spark: SparkSession) -> bool:
    """Whether the executors can hold the rows and, of each row, its node in every tree.

    Then a level starts from these nodes and does not walk every row down every tree again;
    the trees are the same. What does not fit goes to disk, and reading that back costs what
    the walk does.
    """
    return rows * (ROW_BYTES + trees * TREE_BYTES) <= executor_memory(spark)


def _forest(label: str, remember: bool) -> RandomForestClassifier:
    """A forest to be fitted; nodes are not checkpointed, as they follow from the rows."""
    return RandomForestClassifier(
        labelCol=label, featuresCol="features", seed=SEED, cacheNodeIds=remember, checkpointInterval=-1
    )


def train_classifier(
    train: DataFrame, settings: ForestSettings = ForestSettings(), label: str = LABEL
) -> RandomForestClassificationModel:
    forest = _forest(label, remembers(train.count(), settings.trees, train.sparkSession))
    return forest.setParams(
        numTrees=settings.trees, maxDepth=settings.depth, minInstancesPerNode=settings.least_rows
    ).fit(train)


def _roc_evaluator(label: str) -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")


def classifier_metrics(scored: DataFrame, label: str = LABEL, digits: int = 4) -> DataFrame:
    """Metric and value: AUC, accuracy, weighted precision and recall, F1."""
    with held(scored.select(label, "prediction", "rawPrediction")) as rows:
        auc = _roc_evaluator(label).evaluate(rows)
        measured = weighted_metrics(rows, label).first()
    values = {
        "auc": auc,
        "accuracy": measured["accuracy"],
        "precision": measured["weighted_precision"],
        "recall": measured["weighted_recall"],
        "f1": measured["f1"],
    }
    spark = scored.sparkSession
    table = spark.createDataFrame(list(values.items()), "metric string, value double")
    return table.withColumn("value", F.round("value", digits))


def feature_importances(
    spark: SparkSession, model: RandomForestClassificationModel, names: Sequence[str], top: int = 10
) -> DataFrame:
    """The ``top`` features by importance, each vector position under its own name."""
    values = model.featureImportances.toArray()
    if len(values) != len(names):
        raise ValueError(f"{len(names)} names for {len(values)} features")
    rows = [(n, float(v)) for n, v in zip(names, values)]
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(top)


# --- Regressor ---------------------------------------------------------------


def fare_vectors(inputs: DataFrame) -> DataFrame:
    """Vectors of the fare model's inputs, and the fare."""
    assembler = VectorAssembler(
        inputCols=list(FARE_FEATURES), outputCol="features", handleInvalid="skip"
    )
    return assembler.transform(inputs).select("features", FARE_TARGET)


def train_regressor(train: DataFrame, target: str = FARE_TARGET) -> LinearRegressionModel:
    """Ridge regression; with few features Spark solves it in a single pass."""
    return LinearRegression(
        labelCol=target, featuresCol="features", maxIter=10, regParam=0.1, elasticNetParam=0.0
    ).fit(train)


def fit_fares(
    clean: DataFrame, train_share: float = 0.8
) -> tuple[LinearRegressionModel, DataFrame]:
    """The fare model fitted on one part of the trips, and its predictions on the rest."""
    model, _, scored = fit_fare_parts(clean, train_share)
    return model, scored


def fit_fare_parts(
    clean: DataFrame, train_share: float = 0.8
) -> tuple[LinearRegressionModel, DataFrame, DataFrame]:
    """The fare model and its predictions on both parts, the part it was fitted on first."""
    train, test = (fare_vectors(part) for part in train_test(fare_inputs(clean), train=train_share))
    model = train_regressor(train)
    return model, model.transform(train), model.transform(test)


def ridge_slopes(model: LinearRegressionModel, train: DataFrame, target: str = FARE_TARGET) -> DataFrame:
    """Per feature, the slope of the penalised squared error at the model's coefficients.

    Features count in deviations, as the penalty does. All slopes are zero at the minimum.
    """
    weights = [float(w) for w in model.coefficients]
    x = vector_to_array("features")
    error = F.col("prediction") - F.col(target)
    parts = [(F.covar_pop(x[j], error), F.stddev_samp(x[j])) for j in range(len(weights))]
    penalty = model.getRegParam()
    slopes = [
        F.struct(F.lit(j).alias("position"), (F.try_divide(c, d) + F.lit(penalty * w) * d / F.stddev_samp(target)).alias("slope"))
        for j, ((c, d), w) in enumerate(zip(parts, weights))
    ]
    return train.agg(F.explode(F.array(*slopes)).alias("s")).select("s.*")


def fare_metrics(scored: DataFrame, digits: int = 4) -> DataFrame:
    return regression_metrics(scored, FARE_TARGET, digits=digits)


# --- Tuning ------------------------------------------------------------------


@contextmanager
def tuning_rows(train: DataFrame, share: float):
    """The rows to tune on, held where they are drawn.

    Whole tables are not held: each fold caches its parts of them anyway. They have to come from
    files, so that both parts of a fold meet the rows in the same order.
    """
    if share < 1.0:
        with held(bernoulli(train, share, SEED)) as rows:
            yield rows
    else:
        yield train


def tune_classifier(
    train: DataFrame, grid: TuningGrid = TuningGrid(), label: str = LABEL
) -> CrossValidatorModel:
    """Cross-validated grid search by AUC over all training rows, or a share of them if the grid says so.

    Forests that are fitted at the same time share the memory for remembered nodes.
    """
    with tuning_rows(train, grid.sample) as rows:
        at_once = rows.count() * max(1, grid.parallelism)
        forest = _forest(label, remembers(at_once, max(grid.trees), train.sparkSession))
        candidates = (
            ParamGridBuilder()
            .addGrid(forest.numTrees, list(grid.trees))
            .addGrid(forest.maxDepth, list(grid.depths))
            .addGrid(forest.minInstancesPerNode, list(grid.least_rows))
            .build()
        )
        search = CrossValidator(
            estimator=forest,
            estimatorParamMaps=candidates,
            evaluator=_roc_evaluator(label),
            numFolds=grid.folds,
            seed=SEED,
            parallelism=grid.parallelism,
        )
        return search.fit(rows)


def leaderboard(spark: SparkSession, tuned: CrossValidatorModel) -> DataFrame:
    """Mean AUC of every combination, best first."""
    rows = []
    for combination, auc in zip(tuned.getEstimatorParamMaps(), tuned.avgMetrics):
        by_name = {param.name: value for param, value in combination.items()}
        rows.append(
            (by_name["numTrees"], by_name["maxDepth"], by_name["minInstancesPerNode"], float(auc))
        )
    table = spark.createDataFrame(rows, "trees int, depth int, least_rows int, auc double")
    return table.orderBy(F.desc("auc"), "trees", "depth", "least_rows")


def compare(baseline: DataFrame, tuned: DataFrame) -> DataFrame:
    """Two metric tables side by side, and by how much the second is better."""
    first = baseline.withColumnRenamed("value", "baseline")
    second = tuned.withColumnRenamed("value", "tuned")
    return first.join(second, "metric").withColumn(
        "delta", F.round(F.col("tuned") - F.col("baseline"), 4)
    )
