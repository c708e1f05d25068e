"""Clock and calendar columns; both timestamp types work."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterline.functions.numeric import round_half_up
from meterline.schema import DAY_PARTS, LAST_DAY_PART


def elapsed_seconds(start: str, end: str) -> str:
    """SQL for the whole seconds from start to end."""
    return f"unix_timestamp(`{end}`) - unix_timestamp(`{start}`)"


def elapsed_minutes(start: str, end: str) -> Column:
    """Minutes from start to end, to two decimals."""
    return round_half_up(f"({elapsed_seconds(start, end)}) / 60D", 2)


def weekend_flag(weekday: str) -> Column:
    """1 on Saturday (7) and Sunday (1), else 0; ``weekday`` is an SQL expression."""
    return F.expr(f"IF({weekday} IN (1, 7), 1, 0)")


def day_part(hour: str) -> Column:
    """night 0-5, morning 6-11, afternoon 12-17, evening for the rest."""
    firsts = [0, *[last + 1 for last, _ in DAY_PARTS]]
    cases = " ".join(
        f"WHEN {hour} BETWEEN {first} AND {last} THEN '{label}'"
        for first, (last, label) in zip(firsts, DAY_PARTS)
    )
    return F.expr(f"CASE {cases} ELSE '{LAST_DAY_PART}' END")


def within_days(moment: str, first: str, end: str) -> Column:
    """Half-open range of days as plain comparisons, so that a Parquet scan takes it."""
    moment = F.col(moment)
    return (moment >= F.lit(first).cast("timestamp_ntz")) & (
        moment < F.lit(end).cast("timestamp_ntz")
    )
