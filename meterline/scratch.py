"""Where jobs keep tables that outlive one stage, and how much memory there is to hold rows."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the session names for checkpoints.

    Only a local session without one falls back to a temporary folder: there
    every task runs on this machine. A cluster has to name a shared folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    made = tempfile.mkdtemp(prefix="meterline-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def executor_memory(spark: SparkSession) -> int:
    """Bytes that the executors have left for rows that are held; the driver's count only where it works alone."""
    status = spark.sparkContext._jsc.sc().getExecutorMemoryStatus()
    left, entries = {}, status.iterator()
    while entries.hasNext():
        entry = entries.next()
        left[entry._1()] = entry._2()._2()
    driver = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().blockManagerId().hostPort()
    return sum(size for place, size in left.items() if place != driver or len(left) == 1)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet, below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists, on whatever file system it names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(files.exists(target))


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a finished job wrote this folder (it left its success marker)."""
    return path_exists(spark, f"{path}/_SUCCESS")


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """One small text at a path, replaced as a whole."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = files.create(target, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def read_note(spark: SparkSession, path: str) -> str | None:
    """The text of a note; None if there is none."""
    if not path_exists(spark, path):
        return None
    return spark.read.text(path, wholetext=True).agg(F.max("value")).first()[0]


def file_sizes(spark: SparkSession, paths: list[str]) -> list[tuple[str, int, int]]:
    """Name, length and time of change of files."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for path in sorted(paths):
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        status = target.getFileSystem(hadoop).getFileStatus(target)
        found.append((path, status.getLen(), status.getModificationTime()))
    return found


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """One small text at a path that must not exist yet."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = files.create(target, False)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def folders(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names of what lies below a path and begins with the prefix, without the prefix."""
    if not path_exists(spark, path):
        return []
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(target)
    names = [str(status.getPath().getName()) for status in listed]
    return [n.removeprefix(prefix) for n in names if n.startswith(prefix)]


def numbered(spark: SparkSession, path: str, pattern: str) -> list[int]:
    """Numbers of the files below a path whose names follow a pattern with one number."""
    head, _, rest = pattern.partition("{")
    tail = rest.partition("}")[2]
    found = [n.removesuffix(tail) for n in folders(spark, path, head) if n.endswith(tail)]
    return [int(n) for n in found if n.isdecimal()]
