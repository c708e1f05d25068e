"""Samples and splits."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, UserDefinedType, VariantType

from meterline.functions.hashing import HASH_BITS, HASH_SPACE, row_hash

# Bits of the hash that each round of a search for one hash tells apart, from the upper ones on.
_ROUNDS = (16, 18, 18)
assert sum(_ROUNDS) == HASH_BITS


def bernoulli(df: DataFrame, fraction: float, seed: int = 42, by: Column | None = None) -> DataFrame:
    """Keep each row with the given probability.

    With a row hash in ``by`` the same rows come out of every run and every layout;
    without one Spark draws per partition.
    """
    if by is None:
        return df.sample(fraction=fraction, seed=seed)
    return df.filter(by < F.lit(int(fraction * HASH_SPACE)))


def nth_hash(df: DataFrame, n: int, by: Column) -> tuple[int, int] | None:
    """The n-th least hash of the rows, and how many rows have a lesser one; None if there are fewer rows.

    Each round counts the rows of equal parts of the range that holds the hash, at most 2^18
    of them, and goes on with the part that the n-th row falls into. Only those counts meet
    in one task; one row a round comes back.
    """
    hashed = df.select(by.alias("hash"))
    low, width, below = 0, HASH_SPACE, 0
    for bits in _ROUNDS:
        width >>= bits
        inside = (F.col("hash") >= low) & (F.col("hash") < low + (width << bits))
        part = F.expr(f"(hash - {low}L) div {width}L")
        sizes = hashed.filter(inside).groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size"))
        upto = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
        found = sizes.withColumn("upto", upto).filter(F.col("upto") + below >= n).orderBy("part").first()
        if found is None:
            return None
        low, below = low + found["part"] * width, below + found["upto"] - found["size"]
    return low, below


def fixed_size(df: DataFrame, n: int, by: Column) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer): those of least hash.

    The hash of the n-th row is found first, so taking the rows is a filter in whatever
    tasks they are, however many. Only rows of that very hash are put in order, by their
    columns, as not all of them may be taken.
    """
    if n <= 0:
        return df.limit(0)
    found = nth_hash(df, n, by)
    if found is None:
        return df
    last, below = found
    hashed = df.withColumn("_hash", by)
    ties = hashed.filter(F.col("_hash") == last).orderBy(*[F.col(f"`{c}`") for c in df.columns if _sortable(df, c)]).limit(n - below)
    return hashed.filter(F.col("_hash") < last).unionAll(ties).drop("_hash")


def _sortable(df: DataFrame, column: str) -> bool:
    return not isinstance(df.schema[column].dataType, (MapType, UserDefinedType, VariantType))


def split_by_hash(df: DataFrame, weights: Sequence[float], by: Column) -> list[DataFrame]:
    """Disjoint parts whose sizes follow the weights; together they are the table.

    Each row's part follows from its hash alone, so a task that runs again puts it in
    the same part.
    """
    total = float(sum(weights))
    bounds = [0, *[int(w / total * HASH_SPACE) for w in accumulate(weights)]]
    bounds[-1] = HASH_SPACE
    return [
        df.filter((by >= F.lit(low)) & (by < F.lit(high)))
        for low, high in zip(bounds, bounds[1:])
    ]


def train_flag(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    train: float = 0.8,
    seed: int = 42,
    by: Column | None = None,
) -> Column:
    """Whether a row belongs to the train part of :func:`train_test`."""
    chosen = row_hash(list(keys or df.columns), seed) if by is None else by
    return chosen < F.lit(int(train * HASH_SPACE))


def random_split(df: DataFrame, weights: Sequence[float], seed: int = 42) -> list[DataFrame]:
    """Spark's own random split; its parts depend on how the rows are laid out."""
    return df.randomSplit(list(weights), seed=seed)


def train_test(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    train: float = 0.8,
    seed: int = 42,
    by: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """80/20 by default, by a hash over the keys or, without keys, over the whole row.

    Rows that agree in all of them land on the same side.
    """
    chosen = train_flag(df, keys, train, seed, by)
    return df.filter(chosen), df.filter(~chosen)
