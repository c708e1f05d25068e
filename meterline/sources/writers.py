"""Writers: partitioned tables, database tables with a CSV fallback, models."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Literal

from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline import scratch
from meterline.schema import LABEL, MONTH

NO_DATABASE = "no database given"

IfPresent = Literal["skip", "overwrite", "overwrite_partitions"]


def write_partitioned(
    df: DataFrame,
    path: str,
    by: str = MONTH,
    if_present: IfPresent = "overwrite",
    rebalance: bool = True,
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> bool:
    """Write Parquet in one folder per value of ``by``; True if anything was written.

    ``skip`` leaves a table alone that a finished job wrote; a half-written one is
    written again. ``overwrite_partitions`` replaces only the folders that occur in
    ``df``. Rebalancing gathers each folder's rows into files of the advisory size and
    splits big folders over many tasks; without it every task writes to every folder.
    ``derive`` adds what follows from each row alone after that shuffle, so it need not
    pass through it; it keeps ``by`` as it is.
    """
    spark = df.sparkSession
    if if_present == "skip" and scratch.is_complete(spark, path):
        return False
    laid_out = df.hint("rebalance", F.col(by)) if rebalance else df
    whole = derive(laid_out) if derive else laid_out
    writer = whole.write.mode("overwrite").partitionBy(by)
    if if_present == "overwrite_partitions":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.option("partitionOverwriteMode", "static")
    writer.parquet(path)
    return True


def count_partitions(spark: SparkSession, path: str, by: str = MONTH) -> DataFrame:
    """Rows per folder of a written table, read back from it."""
    return spark.read.parquet(path).groupBy(by).agg(F.count(F.lit(1)).alias("row_count")).orderBy(by)


def write_table(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """CSV with a header. ``single_file`` is for reports of a few thousand rows."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)
    return path


@dataclass(frozen=True)
class Delivery:
    """Where a report ended up; ``problem`` says why not in the database."""

    kind: Literal["jdbc", "csv"]
    location: str
    problem: str | None = None

    def told(self) -> str | None:
        """What a report of the run has to say: why a database that was named was not reached."""
        return None if self.problem in (None, NO_DATABASE) else f"csv fallback: {self.problem}"


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    batch_rows: int = 10_000,
    connections: int = 8,
) -> None:
    """Replace the rows of a database table, keeping the table itself.

    ``connections`` bounds how many tasks write at once.
    """
    settings = {"batchsize": str(batch_rows), "truncate": "true", "numPartitions": str(connections)}
    df.write.mode("overwrite").options(**settings).jdbc(url=url, table=table, properties=properties)


def deliver_report(
    report: DataFrame,
    table: str,
    url: str | None,
    properties: dict[str, str] | None,
    csv_path: str,
) -> Delivery:
    """A small report to the database or, if that fails, to one CSV file.

    The failure is part of the answer, so that the caller can act on it.
    """
    problem = NO_DATABASE
    if url is not None:
        try:
            write_jdbc(report, url, table, properties or {})
            return Delivery("jdbc", table)
        except Exception as error:  # noqa: BLE001 - drivers raise anything through the JVM
            problem = ": ".join([type(error).__name__, *str(error).splitlines()[:1]])
    return Delivery("csv", write_csv(report, csv_path, single_file=True), problem)


def write_predictions(scored: DataFrame, path: str, label: str = LABEL) -> str:
    """Label, prediction and confidence, nothing else."""
    return write_table(scored.select(label, "prediction", "confidence"), path)


def write_splits(rows: DataFrame, path: str, by: str = "part") -> str:
    """All parts of a split in one pass and one commit, a folder per part."""
    rows.write.mode("overwrite").partitionBy(by).parquet(path)
    return path


def save_model(model: MLWritable, path: str) -> str:
    model.write().overwrite().save(path)
    return path
