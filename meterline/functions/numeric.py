"""Arithmetic that gives the same answer in any order and never divides by zero."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def round_half_up(value: str, digits: int) -> Column:
    """Spark's ``round`` of an SQL expression, of which only values near a tie pay the price.

    ``round`` goes through the decimal text of every double. Away from ties the nearest
    multiple is the same number, and one rounding instruction finds it. Adding zero turns
    -0.0 into 0.0.
    """
    scale = f"1e{digits}D"
    scaled = f"(({value}) * {scale})"
    return F.expr(
        f"CASE WHEN abs({scaled} - rint({scaled})) < 0.499999D AND abs({scaled}) < 1e9D"
        f" THEN rint({scaled}) / {scale} + 0D ELSE round({value}, {digits}) END"
    )


def rounds_into(value: str, low: float | None, high: float | None, digits: int) -> Column:
    """Whether the rounded value of an SQL expression lies in [low, high], without rounding.

    For bounds that are not negative: half a step outside them is where rounding flips.
    """
    half = Decimal(5).scaleb(-digits - 1)
    terms = []
    if low is not None:
        terms.append(f"({value}) >= {Decimal(str(low)) - half}D")
    if high is not None:
        terms.append(f"({value}) < {Decimal(str(high)) + half}D")
    return F.expr(" AND ".join(terms))


def ratio(part: str, whole: str, digits: int | None = None) -> Column:
    """``part / whole`` of two SQL expressions; null where ``whole`` is zero."""
    quotient = f"try_divide({part}, {whole})"
    return F.expr(quotient) if digits is None else round_half_up(quotient, digits)


def percent(part: Column | str, whole: Column | str, digits: int = 1) -> Column:
    """Share of ``whole`` in percent."""
    share = F.try_divide(_as_column(part).cast("double"), _as_column(whole).cast("double"))
    return F.round(share * 100.0, digits)


def clip(value: Column | str, low: float, high: float) -> Column:
    """The value, moved to the nearer bound where it lies outside; null stays null."""
    value = _as_column(value)
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def hit(left: Column, right: Column) -> Column:
    """1 where both sides are equal, 0 where they differ."""
    return (left == right).cast("int")
