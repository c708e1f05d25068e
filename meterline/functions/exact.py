"""Sums of doubles that are exact: the same bits in any order, for any doubles.

A double is cut into five signed integers of 24 bits. Doubles of similar size, 48 exponents
wide, share a band, within which the cutting is exact; the usual sizes are one band. The
integers of a band are added up as longs, which is exact in any order and safe up to 2^38 rows
of a group, and merge inside tasks before they are shuffled. Per group there are at most 44
bands. Their sums are then lined up as digits of one number to the base 2^24, carried, and
rounded once: the result is the double nearest to the true sum, ties to even.

NaN, and both infinities together, give NaN; one infinity gives itself; a sum beyond the
largest double gives infinity. Nulls are left out, and a group without values has no sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECES = 5
WIDTH = 24  # bits of a piece, and of a digit
STRIDE = 48  # exponents of a band
UPPER = 22  # a unit of the first piece of band 0 is 2^22
LOWEST = 20  # band 0 begins at 2^-20
UNIT = UPPER - WIDTH * (PIECES - 1)  # a unit of the last piece of band 0 is 2^UNIT
SPARE = 3  # digits that carrying may add
BASE = 1 << WIDTH

_LEAST, _MOST = f"{2.0**-LOWEST!r}D", f"{2.0 ** (STRIDE - LOWEST)!r}D"


def _sized(x: str) -> tuple[str, str, str]:
    """SQL of what a value x becomes: the double in its band, the band, and what sort of value it is.

    The sort is null for a null, 1 for NaN, 2 and 3 for the infinities, else 0. Two bits of
    slack in every band cover the error of the logarithm.
    """
    size = f"abs({x})"
    usual = f"({x} = 0D OR ({size} >= {_LEAST} AND {size} < {_MOST}))"
    finite = f"({size} < double('infinity'))"
    band = f"floor((log2({size}) + {LOWEST}) / {STRIDE})"
    half = f"pow(2D, {-STRIDE // 2}D * {band})"
    return (
        f"CASE WHEN {usual} THEN {x} WHEN {finite} THEN {x} * {half} * {half} END",
        f"CASE WHEN {usual} THEN 0 WHEN {finite} THEN CAST({band} AS INT) ELSE 0 END",
        f"CASE WHEN {x} IS NULL THEN NULL WHEN {finite} THEN 0 WHEN isnan({x}) THEN 1 WHEN {x} > 0D THEN 2 ELSE 3 END",
    )


def _piece(i: int) -> str:
    """SQL of the sum of a piece: what one more digit adds to the value, exact in doubles as they agree above it."""
    upto = [f"rint(y * {2.0 ** (WIDTH * k - UPPER)!r}D)" for k in (i - 1, i)]
    digit = upto[1] if i == 0 else f"{upto[1]} - {upto[0]} * {float(BASE)!r}D"
    return f"coalesce(sum(CAST({digit} AS BIGINT)), 0L)"


def _let(name: str, value: str, body: str) -> str:
    """SQL of a body that uses a value several times under a name, worked out once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _total(parts: str) -> str:
    """SQL from the parts (band, sums, rows, n, nans, ups, downs) of one column to its (total, n, rows).

    ``lined`` has the piece sums of all bands there are at their places, lowest first; ``digits`` are
    carried, from 0 to 2^24 - 1, of the number without its ``sign``; ``top`` is the place of
    the highest that is not zero. Four digits and a bit for whatever stands below make a
    decimal whose rounding is the number's own; the power of two is applied in two exact steps.
    """
    per = STRIDE // WIDTH
    low, size = "array_min(transform(parts, p -> p.band))", f"((array_max(transform(parts, p -> p.band)) - low) * {per} + {PIECES + SPARE})"
    high = f"((p.band - low) * {per} + {PIECES - 1})"
    lined = (
        f"aggregate(parts, array_repeat(0L, {size}), (ds, p) -> transform(ds, (d, i) -> d + CASE WHEN i <= {high}"
        f" AND i > {high} - {PIECES} THEN get(p.sums, {high} - i) ELSE 0L END))"
    )
    carried = (
        "aggregate(lined, named_struct('carry', 0L, 'digits', cast(array() AS array<bigint>)), (s, d) -> named_struct("
        f"'carry', shiftright(d * {{sign}} + s.carry, {WIDTH}), 'digits', concat(s.digits, array((d * {{sign}} + s.carry) & {BASE - 1}L))))"
    )
    sign = f"if({carried.format(sign='1L')}.carry < 0, -1L, 1L)"
    top = "aggregate(digits, named_struct('i', 0, 'top', -1), (s, d) -> named_struct('i', s.i + 1, 'top', if(d != 0, s.i, s.top))).top"
    shown = " + ".join(
        f"(CAST(if(top >= {k}, get(digits, top - {k}), 0L) AS DECIMAL(8, 0)) * CAST('{1 << (WIDTH * (3 - k) + 1)}' AS DECIMAL(24, 0)))" for k in range(4)
    )
    below = "if(exists(slice(digits, 1, greatest(top - 3, 0)), d -> d != 0), 1, 0)"
    power = f"((top - 3) * {WIDTH} + low * {STRIDE} + {UNIT - 1})"
    near = f"({power} div 2)"
    finite = f"if(top < 0, 0D, sign * CAST({shown} + {below} AS DOUBLE) * pow(2D, {near}) * pow(2D, {power} - {near}))"
    finite = _let("low", low, _let("lined", lined, _let("sign", sign, _let("digits", f"{carried.format(sign='sign')}.digits", _let("top", top, finite)))))
    added = ", ".join(f"'{f}', aggregate(parts, 0L, (s, p) -> s + p.{f})" for f in ("rows", "n", "nans", "ups", "downs"))
    total = (
        "CASE WHEN c.n = 0 THEN NULL WHEN c.nans > 0 OR (c.ups > 0 AND c.downs > 0) THEN double('NaN')"
        f" WHEN c.ups > 0 THEN double('infinity') WHEN c.downs > 0 THEN -double('infinity') ELSE {finite} END"
    )
    return _let("parts", parts, _let("c", f"named_struct({added})", f"named_struct('total', {total}, 'n', c.n, 'rows', c.rows)"))


COUNTS = ("rows", "n", "nans", "ups", "downs")


def partial_sums(df: DataFrame, keys: Sequence[str | Column], columns: Sequence[str]) -> DataFrame:
    """Per group, column and band: the keys, ``which`` column, ``band``, the piece sums p0 to p4, and COUNTS.

    Such rows of several tables may be put together, or stored, and finished later.
    """
    named = [F.col(k) if isinstance(k, str) else k for k in keys]
    names = df.select(*named).columns
    own = [f"_key{i}" for i in range(len(names))]
    held = df.select(*[k.alias(o) for k, o in zip(named, own)], *[F.col(f"`{c}`").cast("double").alias(f"_x{i}") for i, c in enumerate(columns)])
    # Sizes are worked out below the split into rows, once a value.
    sized = {f"_{part}{i}": F.expr(sql) for i in range(len(columns)) for part, sql in zip("ybs", _sized(f"_x{i}"))}
    rows = ", ".join(f"{i}, _y{i}, _b{i}, _s{i}" for i in range(len(columns)))
    long = held.withColumns(sized).select(*own, F.expr(f"stack({len(columns)}, {rows}) AS (which, y, band, sort)"))
    cut = long.groupBy(*own, "which", "band").agg(
        *[F.expr(_piece(i)).alias(f"p{i}") for i in range(PIECES)], F.expr("count(1) AS rows"), F.expr("count(sort) AS n"),
        *[F.expr(f"count_if(sort = {i})").alias(name) for i, name in enumerate(COUNTS[2:], 1)],
    )
    return cut.withColumnsRenamed(dict(zip(own, names)))


def merged(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per group, column and band of partial sums that were put together."""
    added = [F.sum(c).alias(c) for c in (*[f"p{i}" for i in range(PIECES)], *COUNTS)]
    return partials.groupBy(*[f"`{k}`" for k in keys], "which", "band").agg(*added)


def finished(partials: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """From partial sums, one row per group, column and band, what :func:`exact_sums` gives."""
    # At most 44 bands of each column.
    part = f"struct(which, band, array({', '.join(f'p{i}' for i in range(PIECES))}) AS sums, {', '.join(COUNTS)})"
    parts = partials.groupBy(*[f"`{k}`" for k in keys]).agg(F.expr(f"collect_list({part})").alias("_every"))
    each = _total("filter(_every, p -> p.which = w)")
    done = parts.withColumn("_found", F.expr(f"transform(sequence(0, {len(columns) - 1}), w -> {each})"))
    sums = [F.expr(f"_found[{i}].{field}").alias(f"{name}_{c}") for i, c in enumerate(columns) for field, name in (("total", "sum"), ("n", "n"))]
    return done.select(*[F.col(f"`{k}`") for k in keys], F.expr("_found[0].rows").alias("row_count"), *sums)


def exact_sums(df: DataFrame, keys: Sequence[str | Column], columns: Sequence[str]) -> DataFrame:
    """Per group: the keys, ``row_count``, and for each column ``sum_<column>`` and ``n_<column>``, its values.

    One pass over ``df``; every row is looked at once per column. Without keys there is
    always one row.
    """
    names = df.select(*[F.col(k) if isinstance(k, str) else k for k in keys]).columns
    return finished(partial_sums(df, keys, columns), names, columns)


def exact_means(df: DataFrame, keys: Sequence[str | Column], columns: Sequence[str]) -> DataFrame:
    """Per group: the keys, ``row_count``, and for each column ``mean_<column>``, the exact sum by the number of values."""
    sums = exact_sums(df, keys, columns)
    kept = sums.columns[: len(sums.columns) - 2 * len(columns)]
    return sums.select(*[f"`{k}`" for k in kept], *[F.try_divide(f"sum_{c}", f"n_{c}").alias(f"mean_{c}") for c in columns])
