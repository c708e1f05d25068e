"""Bring files with drifting schemas onto one set of columns and types."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StructType

from meterline.schema import LONG_COLUMNS

LONG_TARGETS: dict[str, DataType] = {name: LongType() for name in LONG_COLUMNS}


@dataclass(frozen=True)
class UnionReport:
    """Which columns a union kept, and which it left out per input."""

    kept: tuple[str, ...]
    dropped: dict[str, tuple[str, ...]]


def lower_names(columns: Iterable[str]) -> list[str]:
    """Lower-case the names; refuse two that differ only by case."""
    names = [c.lower() for c in columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"columns that differ only by case: {', '.join(twice)}")
    return names


def normalize(df: DataFrame, targets: dict[str, DataType] | None = None) -> DataFrame:
    """Lower-case every name and cast the columns that ``targets`` lists, in one projection.

    A value that does not fit its target becomes null instead of failing the job.
    """
    targets = LONG_TARGETS if targets is None else targets
    picked = []
    for old, new in zip(df.columns, lower_names(df.columns)):
        column = F.col(f"`{old}`")
        if new in targets and df.schema[old].dataType != targets[new]:
            column = column.try_cast(targets[new])
        picked.append(column.alias(new))
    return df.select(*picked)


def common_columns(column_sets: dict[str, Sequence[str]]) -> UnionReport:
    """Names that every input has, sorted, and what each input has beyond them."""
    kept = sorted(set.intersection(*[set(c) for c in column_sets.values()]))
    dropped = {
        name: tuple(sorted(set(columns) - set(kept))) for name, columns in column_sets.items()
    }
    return UnionReport(tuple(kept), {k: v for k, v in dropped.items() if v})


def union_common(frames: dict[str, DataFrame]) -> tuple[DataFrame, UnionReport]:
    """UNION ALL over the columns that all frames share, sorted by name."""
    report = common_columns({name: df.columns for name, df in frames.items()})
    parts = [df.select(*report.kept) for df in frames.values()]
    return reduce(DataFrame.unionByName, parts), report


def signature(schema: StructType) -> tuple[tuple[str, str], ...]:
    """Names and types, for telling apart files that need separate scans."""
    return tuple(sorted((f.name, f.dataType.simpleString()) for f in schema.fields))
