"""From clean trips to feature vectors."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Literal

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from meterline.functions.vectors import likeness
from meterline.operators.cleaning import without_leakage
from meterline.operators.reports import distribution
from meterline.operators.sampling import train_flag
from meterline.schema import CATEGORICAL_FEATURES, LABEL, NUMERIC_FEATURES
from meterline.scratch import read_note, write_note
from meterline.sources.readers import load_features, read_splits
from meterline.sources.writers import save_model, write_splits

RAW_FEATURES = "features_raw"
FEATURES = "features"


def feature_stages(
    categorical: tuple[str, ...] = CATEGORICAL_FEATURES,
    numeric: tuple[str, ...] = NUMERIC_FEATURES,
) -> Pipeline:
    """Index and one-hot encode the categories, assemble all, scale to mean 0 and deviation 1.

    Fitting reads the table twice: once for all category counts, once for the scale.
    Categories not seen in fitting, and nulls, share one extra index; rows with a null
    number are left out.
    """
    indexed = [f"{c}_idx" for c in categorical]
    encoded = [f"{c}_enc" for c in categorical]
    return Pipeline(
        stages=[
            StringIndexer(
                inputCols=list(categorical),
                outputCols=indexed,
                handleInvalid="keep",
                stringOrderType="frequencyDesc",
            ),
            OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
            VectorAssembler(
                inputCols=[*numeric, *encoded], outputCol=RAW_FEATURES, handleInvalid="skip"
            ),
            StandardScaler(inputCol=RAW_FEATURES, outputCol=FEATURES, withMean=True, withStd=True),
        ]
    )


def slot_names(stages: PipelineModel, vectors: DataFrame) -> list[str]:
    """Name of every position of the assembled vector, taken from its metadata."""
    return vector_names(stages.transform(vectors.limit(0)), RAW_FEATURES)


def vector_names(df: DataFrame, column: str) -> list[str]:
    """Names that a vector column carries in its metadata, in order."""
    groups = df.schema[column].metadata["ml_attr"]["attrs"]
    found = sorted((a["idx"], a["name"]) for group in groups.values() for a in group)
    return [name for _, name in found]


def index_levels(spark: SparkSession, stages: PipelineModel) -> DataFrame:
    """The categories the indexer found: column, category, position."""
    indexer = next(s for s in stages.stages if isinstance(s, StringIndexerModel))
    rows = [
        (column, value, position)
        for column, values in zip(indexer.getInputCols(), indexer.labelsArray)
        for position, value in enumerate(values)
    ]
    return spark.createDataFrame(rows, "input string, category string, position int")


def scale_parameters(spark: SparkSession, stages: PipelineModel, sample: DataFrame) -> DataFrame:
    """Mean and deviation the scaler found for every vector position."""
    scaler = stages.stages[-1]
    rows = zip(
        range(len(scaler.mean)),
        slot_names(stages, sample),
        [float(x) for x in scaler.mean],
        [float(x) for x in scaler.std],
    )
    return spark.createDataFrame(list(rows), "position int, feature string, mean double, stddev double")


@dataclass(frozen=True)
class Prepared:
    """Train and test rows (features and label), the fitted stages, the class shares."""

    train: DataFrame
    test: DataFrame
    stages: PipelineModel
    classes: DataFrame


# Rows that a file of vectors is to hold at most, and at least where there is more than one.
MOST_ROWS, LEAST_ROWS = 2_000_000, 10_000


def evenly(rows: DataFrame, count: int) -> DataFrame:
    """The rows in equal shares, as many as there are cores or a multiple of that.

    Every level of training waits for the largest share and for the last round of tasks, so
    shares that follow from the files before would leave cores idle.

    Each task deals its rows out in turn. That takes no sorting, which would go to disk where a
    task reads millions of rows, but it relies on their order: the rows have to come from files,
    so that a task that runs again deals them alike.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    wanted = cores * max(1, -(-count // (cores * MOST_ROWS)))
    shares = max(1, min(wanted, count // LEAST_ROWS))
    return rows.repartitionById(shares, (F.monotonically_increasing_id() % shares).cast("int"))


def alike(rows: DataFrame, count: int) -> DataFrame:
    """The rows in equal shares, each of them in order of part and likeness.

    Neighbours fall into the same nodes of most trees, so training finds the nodes it walks and
    the counts it adds to still in the processor's cache. Writing the parts sorts each share by
    part in any case; which rows are in a share, and so how large it is, stays as it is.
    """
    keyed = evenly(rows, count).withColumn("_likeness", likeness(FEATURES))
    return keyed.sortWithinPartitions("part", "_likeness").drop("_likeness")


def complete_inputs(clean: DataFrame) -> DataFrame:
    """Model inputs: no leakage columns, no row with a null."""
    return without_leakage(clean).dropna()


def prepare(
    clean: DataFrame,
    folder: str,
    fit_on: Literal["train", "all"] = "train",
    keys: list[str] | None = None,
    by: Column | None = None,
    version: str | None = None,
    written: bool = False,
) -> Prepared:
    """Split, fit the stages, transform, write the parts and the stages below ``folder``.

    The split is taken on the rows before any fitting, so with ``fit_on="train"`` the
    test rows leave no trace in the stages; ``"all"`` fits them on every row.

    ``version`` says what rows and settings went in. A note of it is written last, and only
    a folder with the same note is read back instead of made again; without a version
    everything is made again.

    Training starts from the written tables: a lost executor costs a read, not the
    cleaning before it. The vectors are written in equal shares, similar ones together. ``written`` says that ``clean``
    is read from files itself; else its rows are written once more before the stages are fitted.
    """
    spark = clean.sparkSession
    inputs = complete_inputs(clean)
    stages_path, splits_path, note = f"{folder}/stages", f"{folder}/splits", f"{folder}/version.txt"
    if version is None or read_note(spark, note) != version:
        write_note(spark, note, "")
        part = F.when(train_flag(inputs, keys=keys, by=by), "train").otherwise("test")
        rows = inputs.withColumn("part", part)
        if not written:
            # The parts are written first: cleaning runs once, and fitting reads what it left.
            rows_path = f"{folder}/rows"
            write_splits(rows, rows_path)
            rows = spark.read.schema(StructType([*inputs.schema.fields, StructField("part", StringType())])).parquet(rows_path)
        stages = feature_stages().fit(
            rows.filter(F.col("part") == "train") if fit_on == "train" else rows
        )
        vectors = stages.transform(rows).select(FEATURES, LABEL, "part")
        write_splits(alike(vectors, rows.count()), splits_path)
        save_model(stages, stages_path)
        write_note(spark, note, version or "")
    train, test = read_splits(spark, splits_path)
    return Prepared(train, test, load_features(stages_path), distribution(inputs, LABEL))
