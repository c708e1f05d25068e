"""Readers of monthly files, lookups, partitioned tables, requests and models."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from meterline import scratch
from meterline.schema import MONTH
from meterline.sources import contract

# Fixed format: the month stands before the suffix of the file (or folder) name, or is the
# name of the folder of the file.
MONTH_IN_PATH = r"(\d{4}-\d{2})(?:\.parquet(?:/|$)|/[^/]+$)"

ZONE_SCHEMA = "locationid long, borough string, zone string, service_zone string"

REQUEST_SCHEMA = (
    "payment_type int, trip_distance double, fare_amount double, trip_duration_min double, "
    "pickup_hour int, pickup_dayofweek int, passenger_count int, is_airport_trip int, "
    "ratecodeid int, pulocationid int, dolocationid int, congestion_surcharge double"
)


def _files(spark: SparkSession, paths: Sequence[str]) -> dict[str, str | None]:
    """Every file below the paths with the month its path names; only listings are read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    month = F.regexp_extract("path", MONTH_IN_PATH, 1)
    rows = listed.load(list(paths)).select("path", F.nullif(month, F.lit("")).alias("month")).collect()
    return {r["path"]: r["month"] for r in rows}


def read_months(
    spark: SparkSession,
    paths: Sequence[str],
    targets: dict[str, DataType] | None = None,
) -> tuple[DataFrame, contract.UnionReport]:
    """All monthly files as one table, tagged with the month in the file name.

    Paths may be files or folders of files. The footer of every file is looked at, so files
    of one folder may differ; files with the same schema go into one scan, so the plan grows
    with the number of different schemas, not of files. A file whose path names no month is
    an error. The report names files, or folders where all their files agree.
    """
    if not paths:
        raise ValueError("no files to read")
    found = _files(spark, paths)
    unnamed = sorted(f for f, month in found.items() if month is None)
    if unnamed or not found:
        raise ValueError(f"no month in the name of {', '.join(unnamed[:5])}" if unnamed else "no files to read")
    files = sorted(found)
    with ThreadPoolExecutor(max_workers=16) as readers:
        schemas = dict(zip(files, readers.map(lambda file: spark.read.parquet(file).schema, files)))
    report = contract.common_columns(
        {file: contract.lower_names(schema.names) for file, schema in schemas.items()}
    )
    groups: dict[tuple, list[str]] = {}
    for file, schema in schemas.items():
        groups.setdefault(contract.signature(schema), []).append(file)

    frames = {}
    for members in groups.values():
        # Names as the files spell them: a session may tell capitals apart.
        wanted = StructType(
            [
                StructField(f.name, f.dataType, True)
                for f in schemas[members[0]].fields
                if f.name.lower() in report.kept and f.name.lower() != MONTH
            ]
        )
        scan = spark.read.schema(wanted).parquet(*members)
        month = F.regexp_extract(F.col("_metadata.file_path"), MONTH_IN_PATH, 1)
        tagged = scan.select("*", month.alias(MONTH))
        frames[members[0]] = contract.normalize(tagged, targets)
    table, _ = contract.union_common(frames)
    return table, contract.UnionReport(report.kept, _by_path(report.dropped, files, paths))


def _by_path(dropped: dict[str, tuple[str, ...]], files: Sequence[str], paths: Sequence[str]) -> dict[str, tuple[str, ...]]:
    """The same report under the names the caller used, where all files below a path agree."""
    out = dict(dropped)
    for path in paths:
        below = [f for f in files if f.endswith(path) or f"{path.rstrip('/')}/" in f]
        left = {dropped.get(f, ()) for f in below}
        if len(left) == 1 and (columns := left.pop()):
            out = {f: c for f, c in out.items() if f not in below} | {path: columns}
    return out


def read_lookup(
    spark: SparkSession, path: str, schema: str | None = ZONE_SCHEMA
) -> DataFrame | None:
    """A CSV lookup with a header, names in lower case; None where there is no such file.

    Without a schema the types are inferred, which costs a second pass over the file.
    """
    if not scratch.path_exists(spark, path):
        return None
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    table = reader.csv(path)
    return table.toDF(*contract.lower_names(table.columns))


REJECT = "_rejected"


def read_lookup_checked(spark: SparkSession, path: str, schema: str = ZONE_SCHEMA, header: bool = True) -> tuple[DataFrame, DataFrame] | None:
    """A CSV lookup as (table, rejects); None where there is no such file.

    A line that does not fit the schema is no row of nulls: it goes to the rejects, with its
    file, the line itself, and why: how many fields it has, or which column is of another type.
    """
    if not scratch.path_exists(spark, path):
        return None
    wanted = StructType.fromDDL(schema)
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECT)
    lines = reader.schema(StructType([*wanted.fields, StructField(REJECT, StringType())])).csv(path)
    told = lines.select("*", F.col("_metadata.file_path").alias("_file"))
    good = told.filter(F.col(REJECT).isNull()).select(*[F.col(f.name).alias(f.name.lower()) for f in wanted.fields])
    bad = told.filter(F.col(REJECT).isNotNull()).select(F.col("_file").alias("file"), F.col(REJECT).alias("line"), _reason(F.col(REJECT), wanted).alias("reason"))
    return good, bad


def _reason(line: Column, wanted: StructType) -> Column:
    """Why a line does not fit: the fields it has as text, beside the columns that were read from it."""
    spare = "_more"
    texts = ", ".join([*[f"`{f.name}` string" for f in wanted.fields], f"`{spare}` string"])
    fields = F.from_csv(line, F.lit(texts))
    named = [f.name for f in wanted.fields]
    size = F.size(F.split(F.regexp_replace(line, '"[^"]*"', ""), ",", -1))
    wrong = [
        F.when(fields[f.name].isNotNull() & F.col(f"`{f.name}`").isNull(), F.lit(f"{f.name.lower()} is no {f.dataType.simpleString()}"))
        for f in wanted.fields
    ]
    counted = F.when(size != len(named), F.concat(size.cast("string"), F.lit(f" fields instead of {len(named)}")))
    return F.coalesce(counted, *wrong, F.lit("not readable"))


def read_table(spark: SparkSession, path: str, month: str | None = None) -> DataFrame:
    """A partitioned table, or one month of it (only that folder is read)."""
    table = spark.read.parquet(path)
    return table if month is None else table.filter(F.col(MONTH) == F.lit(month))


def read_partition(spark: SparkSession, path: str, month: str) -> DataFrame:
    """One month by its folder, with the month column still there."""
    return spark.read.option("basePath", path).parquet(f"{path}/{MONTH}={month}")


def read_splits(spark: SparkSession, path: str, by: str = "part") -> tuple[DataFrame, DataFrame]:
    """Train and test rows of a written split; each reads only its own folder."""
    rows = spark.read.parquet(path)
    train, test = (rows.filter(F.col(by) == part).drop(by) for part in ("train", "test"))
    return train, test


def requests_table(spark: SparkSession, rows: Sequence[dict]) -> DataFrame:
    """Scoring requests handed over as records; a field left out is null."""
    schema = StructType.fromDDL(REQUEST_SCHEMA)
    known = {f.name for f in schema.fields}
    for row in rows:
        unknown = sorted(set(row) - known)
        if unknown:
            raise ValueError(f"unknown request fields: {', '.join(unknown)}")
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def load_features(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_classifier(path: str) -> RandomForestClassificationModel:
    return RandomForestClassificationModel.load(path)


def load_regressor(path: str) -> LinearRegressionModel:
    return LinearRegressionModel.load(path)
