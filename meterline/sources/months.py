"""A table kept month by month: only months that changed are written again.

A store is a folder with data, one subfolder per version and month, and with numbered
manifests. A manifest names the version of every month, what its raw rows held (sums of
hashes, not files or times), and how many rows there were and are. An update writes the
changed months as a new version and then one more manifest; that last small file is the
commit. Readers take the greatest whole manifest, so they see all of an update or nothing
of it, and a crash in between leaves the table as it was. Two writers at once cannot both
commit: the manifest's name is taken by whoever comes first.

With every version its partial sums are stored, one row per group, column and band of
sizes. The summary of the whole table is finished from those, without reading it.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from meterline import scratch
from meterline.functions.exact import finished, merged, partial_sums
from meterline.operators.content import content_by, digest
from meterline.schema import MONTH

UPDATE = "source_month string, action string, raw_rows long, row_count long"
NAME = "manifest-{:09d}.json"
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # fixed format: how Spark names the folder of a null


@dataclass(frozen=True)
class Month:
    """A month as a manifest has it; ``version`` is None while no valid row is left of it."""

    month: str | None
    content: str
    raw_rows: int
    rows: int
    version: str | None


@dataclass(frozen=True)
class MonthStore:
    """A store below ``root`` of what ``make`` turns raw months into.

    ``make`` works on rows of a month together, never across months. ``settings`` says how;
    other settings make every month again. ``keys`` and ``sums`` are those of the summary.
    """

    spark: SparkSession
    root: str
    make: Callable[[DataFrame], DataFrame]
    settings: str
    keys: tuple[str, ...]
    sums: tuple[str, ...]

    # --- Manifests ---

    def _manifest_path(self, number: int) -> str:
        return f"{self.root}/manifests/{NAME.format(number)}"

    def manifest(self) -> tuple[int, list[Month]]:
        """Number and months of the greatest whole manifest; (0, []) of a new store."""
        for number in sorted(scratch.numbered(self.spark, f"{self.root}/manifests", NAME), reverse=True):
            lines = (scratch.read_note(self.spark, self._manifest_path(number)) or "").split("\n")
            if len(lines) == 2 and hashlib.sha256(lines[0].encode()).hexdigest() == lines[1]:
                return number, [Month(**m) for m in json.loads(lines[0])]
        return 0, []

    def _commit(self, after: int, months: Sequence[Month]) -> None:
        if self.manifest()[0] != after:
            raise RuntimeError("another update was committed meanwhile")
        # A manifest that a crash cut short keeps its number.
        number = max([after, *scratch.numbered(self.spark, f"{self.root}/manifests", NAME)]) + 1
        told = json.dumps([asdict(m) for m in sorted(months, key=lambda m: (m.month is None, m.month or ""))])
        scratch.write_new(self.spark, self._manifest_path(number), f"{told}\n{hashlib.sha256(told.encode()).hexdigest()}")

    # --- Updates ---

    def update(self, raw: DataFrame, whole: bool = False) -> DataFrame:
        """Bring the store up to the raw rows: UPDATE, one row per month.

        Months that ``raw`` does not have stay as they are, unless it is the ``whole`` table:
        then they go. One pass over ``raw`` compares, and another, over the changed months
        alone, makes them.
        """
        number, old = self.manifest()
        before = {m.month: m for m in old}
        # One row per month on the driver.
        found = {r[MONTH]: r.asDict() for r in content_by(raw, MONTH).collect()}
        now = {m: digest({k: v for k, v in sums.items() if k != MONTH}, self.settings) for m, sums in found.items()}
        changed = [m for m in found if m not in before or before[m].content != now[m]]
        if not scratch.path_exists(self.spark, f"{self.root}/schema.json"):
            scratch.write_note(self.spark, f"{self.root}/schema.json", self.make(raw).schema.json())
        version, rows = self._write(raw, changed) if changed else ("", {})
        kept = {m: e for m, e in before.items() if m not in found and not whole or m in found and m not in changed}
        made = {m: Month(m, now[m], found[m]["rows"], rows.get(m, 0), version if rows.get(m) else None) for m in changed}
        gone = [m for m in before if m not in kept and m not in made]
        if made or gone:
            self._commit(number, [*kept.values(), *made.values()])
        told = [(m, "kept", e.raw_rows, e.rows) for m, e in kept.items()]
        told += [(m, "replaced" if m in before else "added", e.raw_rows, e.rows) for m, e in made.items()]
        told += [(m, "removed", 0, 0) for m in gone]
        return self.spark.createDataFrame(sorted(told, key=lambda t: (t[0] is None, t[0] or "")), UPDATE)

    def _write(self, raw: DataFrame, months: Sequence[str | None]) -> tuple[str, dict[str | None, int]]:
        version = uuid.uuid4().hex
        data, sums = f"{self.root}/data/version={version}", f"{self.root}/sums/version={version}"
        table = self.make(raw.filter(_one_of(months)))
        table.hint("rebalance", F.col(MONTH)).write.partitionBy(MONTH).parquet(data)
        back = self.spark.read.schema(table.schema).parquet(data)
        partial_sums(back, self.keys, self.sums).coalesce(1).write.parquet(sums)
        return version, {r[MONTH]: r["n"] for r in back.groupBy(MONTH).agg(F.count(F.lit(1)).alias("n")).collect()}

    # --- Reading ---

    def table(self) -> DataFrame:
        """All months, each in its version; one scan, whatever the number of versions."""
        _, months = self.manifest()
        held = [m for m in months if m.version]
        kind = self._kind()
        if not held:
            return self.spark.createDataFrame([], kind)
        paths = [f"{self.root}/data/version={m.version}/{MONTH}={NULL_FOLDER if m.month is None else m.month}" for m in held]
        full = StructType([*kind.fields, StructField("version", StringType())])
        return self.spark.read.schema(full).option("basePath", f"{self.root}/data").parquet(*paths).select(*kind.names)

    def _kind(self) -> StructType:
        told = scratch.read_note(self.spark, f"{self.root}/schema.json")
        if told is None:
            raise ValueError(f"{self.root} holds no months yet")
        return StructType.fromJson(json.loads(told))

    def summary_sums(self) -> DataFrame:
        """Sums by the summary's keys, from the stored partial sums of the months' versions."""
        _, months = self.manifest()
        by_version: dict[str, list[str | None]] = {}
        for m in months:
            if m.version:
                by_version.setdefault(m.version, []).append(m.month)
        if not by_version:
            return finished(partial_sums(self.table(), self.keys, self.sums), self.keys, self.sums)
        parts = self.spark.read.option("basePath", f"{self.root}/sums").parquet(*[f"{self.root}/sums/version={v}" for v in by_version])
        valid = F.lit(False)
        for version, own in by_version.items():
            valid = valid | ((F.col("version") == version) & _one_of(own))
        return finished(merged(parts.filter(valid).drop("version"), self.keys), self.keys, self.sums)

    def unused(self) -> list[str]:
        """Versions that no month has any more: of replaced months, or of updates that did not end."""
        used = {m.version for m in self.manifest()[1]}
        return sorted(set(scratch.folders(self.spark, f"{self.root}/data", "version=")) - used)


def _one_of(months: Sequence[str | None]) -> Column:
    named = [m for m in months if m is not None]
    known = F.col(MONTH).isin(*named) if named else F.lit(False)
    return (known | F.col(MONTH).isNull()) if None in months else known
