"""Pattern matches with their places, in Spark's own functions.

Spark gives the texts of all matches and the texts between them, but no offsets. Both
lists together tile the text, so a running sum of lengths in code points is the place of
every match.

Patterns are Java's and are meant to consume no more steps than characters: possessive
quantifiers where giving back could never help, and ``\\G`` with a look-behind where a
match may only begin at the start of a run or where the last match ended.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPANS = "array<struct<start:int,end:int,value:string,left:string>>"
LEFT = 96
BLOCK = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once however often body uses it, lambdas included."""
    return F.transform(F.array(value), body)[0]


def with_matches(frame: DataFrame, text_col: str, patterns: dict[str, str], gate: dict[str, Column] | None = None) -> DataFrame:
    """Adds for each name an array of (start, end, value, left), leftmost and non-overlapping.

    ``left`` is the end of what stands between the match before and this one. ``gate`` may
    name a cheap condition that every text with a match meets; texts that do not meet it
    are not searched.
    """
    gate = gate or {}
    none = F.array().cast("array<string>")
    found = {
        f"_{n}_hits": F.when(gate.get(n, F.lit(True)), F.regexp_extract_all(F.col(text_col), F.lit(p), F.lit(0))).otherwise(none)
        for n, p in patterns.items()
    }
    return frame.withColumns(found).withColumns({n: _placed(text_col, p, f"_{n}_hits") for n, p in patterns.items()}).drop(*found)


def _placed(text_col: str, pattern: str, hits: str) -> Column:
    """The running sum, in blocks: an array that grows by one match costs its length each time."""
    between = F.split(F.col(text_col), pattern, -1)
    pairs = F.filter(
        F.zip_with(between, F.col(hits), lambda p, h: F.struct(p.alias("piece"), h.alias("hit"))), lambda x: x["hit"].isNotNull()
    )
    blocks = let(pairs, lambda w: F.transform(F.sequence(F.lit(0), F.floor((F.size(w) - 1) / BLOCK).cast("int")), lambda i: F.slice(w, i * BLOCK + 1, F.lit(BLOCK))))
    return F.when(F.size(hits) > 0, let(blocks, _matches)).otherwise(F.array().cast(SPANS))


def _matches(blocks: Column) -> Column:
    width = F.transform(
        blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + F.length(x["piece"]) + F.length(x["hit"]))
    )
    ints = F.array().cast("array<int>")
    begins = F.aggregate(
        width,
        F.struct(F.lit(0).alias("at"), ints.alias("out")),
        lambda acc, w: F.struct((acc["at"] + w).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
        lambda acc: acc["out"],
    )

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["piece"])
        end = begin + F.length(x["hit"])
        left = F.substring(x["piece"], -LEFT, LEFT)
        one = F.array(F.struct(begin.alias("start"), end.alias("end"), x["hit"].alias("value"), left.alias("left")))
        return F.struct(end.alias("at"), F.concat(acc["out"], one).alias("out"))

    def placed(block: Column, begin: Column) -> Column:
        start = F.struct(begin.alias("at"), F.array().cast(SPANS).alias("out"))
        return F.aggregate(block, start, step, lambda acc: acc["out"])

    return F.flatten(F.zip_with(blocks, begins, placed))


def tagged(name: str, order: int, spans: Column) -> Column:
    """Spans as (start, order, kind, end), which sorts by place and then by order of kinds."""
    return F.transform(
        spans,
        lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("rank"), F.lit(name).alias("kind"), s["end"].alias("end")),
    )


def joined_text(tags: Column) -> Column:
    """kind:start:end, comma-joined, in the order given."""
    return F.array_join(
        F.transform(tags, lambda t: F.concat_ws(":", t["kind"], t["start"].cast("string"), t["end"].cast("string"))), ","
    )
