"""Run a query in Spark and in DuckDB and compare names, types, rows and values."""

from __future__ import annotations

import contextlib
import io
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark type name to the DuckDB type it has to meet.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def _key(row: tuple) -> tuple:
    return tuple((v is not None, str(type(v)), v) if v is not None else (False, "", 0) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b


def differences(df, db: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs; empty if both sides agree bit by bit."""
    result = db.sql(sql)
    theirs = dict(zip(result.columns, [str(t) for t in result.types]))
    ours = {name: kind for name, kind in df.dtypes}
    if sorted(ours) != sorted(theirs):
        return [f"columns {sorted(ours)} against {sorted(theirs)}"]
    wrong = [
        f"type of {n}: {k} against {theirs[n]}" for n, k in ours.items() if TYPES.get(k) != theirs[n]
    ]
    names = sorted(ours)
    left = sorted((tuple(r[n] for n in names) for r in df.collect()), key=_key)
    order = [result.columns.index(n) for n in names]
    right = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=_key)
    if len(left) != len(right):
        return [*wrong, f"{len(left)} rows against {len(right)}"]
    unequal = [
        (a, b) for a, b in zip(left, right) if not all(_same(x, y) for x, y in zip(a, b))
    ]
    if unequal:
        wrong.append(f"{len(unequal)} of {len(left)} rows differ, first {names}: {unequal[0]}")
    return wrong


def plan_text(df) -> str:
    """The physical plan with all details."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()
