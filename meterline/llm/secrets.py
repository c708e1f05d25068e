"""Credentials in texts: plain patterns, and parts that only count in company.

Three kinds are reported wherever they match: assignments, access identifiers and long
hexadecimal strings. Other parts are too weak alone: short or named identifiers, random
looking strings, and endpoints. A weak part is reported only if the parts it needs begin
within ``SCOPE`` code points of it: an identifier needs a secret, a secret needs an
identifier, an endpoint needs both.

Parts are complementary only if they are different text: a partner must not overlap the part
that asks, and a secret and an identifier that complete an endpoint must not overlap each
other. Where a weak part overlaps a part that says more, it is the same text and counts as that
part alone: a random looking string within anything else, a named identifier within a plain kind.

Linking is an interval join on bins of one scope. Matches of one kind do not overlap and have
a least length, so a bin has a bounded number of parts, and a weak part meets no more than
those of three bins, however crowded its text is.

Defined cases: a null text counts as empty; a null id is an id like any other; rows that
repeat an id and text each give a row, with equal results; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.spans import joined_text, tagged, with_matches
from meterline.scratch import fresh_path

SCOPE = 256

# Patterns of the three kinds that count alone, in the order of reports.
BASE = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
}
VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
VALUE_LEAST = 6

# Parts that only count in company, by the role they play.
WEAK = {
    "id": r"""(?:\b(?i:access_?key(?:_?id)?|client_?id|account|user(?:name)?|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@+/_.=-]{3,}|\b(?:AKIA|ASIA)[A-Z0-9]{8,})""",
    "key": r"\b[A-Za-z0-9+/_-]{20,}+={0,2}",
    "endpoint": r"""(?:\b(?i:https?|jdbc:[a-z]{2,16}|ssh|ftp|amqp|mongodb|redis|postgres(?:ql)?|mysql)://[^\s"'<>]{3,}|\b(?i:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{3,})""",
}
KINDS = (*BASE, *WEAK)
ROLES = {"assign": "secret", "hex": "secret", "key": "secret", "access": "identifier", "id": "identifier", "endpoint": "endpoint"}
NEEDS = {"id": ("secret",), "key": ("identifier",), "endpoint": ("secret", "identifier")}

# A key is random looking if it has these, wherever they stand.
KEY_HAS = ("[0-9]", "[A-Z]")
SAYS_MORE = {"id": tuple(BASE), "key": (*BASE, "id", "endpoint")}

TAG = "array<struct<start:int,rank:int,kind:string,end:int>>"


def _gates(text: Column) -> dict[str, Column]:
    low = F.lower(text)
    named = low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("key")
    return {"assign": named, "access": text.contains("AKIA")}


def parts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, row_id (of id and text), and the places of every kind."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("row_id", F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("~")), "text")))
    found = with_matches(rows, "text", BASE | WEAK, _gates(F.col("text")))
    kept = {
        "assign": F.filter("assign", lambda s: F.length(F.regexp_extract(s["value"], VALUE, 1)) >= VALUE_LEAST),
        "key": F.filter("key", lambda s: s["value"].rlike(KEY_HAS[0]) & s["value"].rlike(KEY_HAS[1])),
    }
    found = found.withColumns(kept)
    return found.select("doc_id", "row_id", *[tagged(k, i, F.col(k)).alias(k) for i, k in enumerate(KINDS)])


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(row_id, weak): the weak parts in whose scope the parts they need occur."""
    secret, identifier = (sum((F.size(k) for k in KINDS if ROLES[k] == r), F.lit(0)) for r in ("secret", "identifier"))
    able = found.filter((secret > 0) & (identifier > 0))
    every = able.select("row_id", F.explode(F.concat(*KINDS)).alias("s")).select("row_id", "s.*").distinct()
    parts = _apart(every, scope)
    role = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])[F.col("kind")]
    partners = parts.select("row_id", role.alias("role"), F.floor(F.col("start") / scope).alias("bin"), F.col("start").alias("p"), F.col("end").alias("q"))
    needs = F.create_map(*[x for k, r in NEEDS.items() for x in (F.lit(k), F.array(*map(F.lit, r)))])[F.col("kind")]
    weak = parts.filter(F.col("kind").isin(*WEAK)).withColumn("role", F.explode(needs))
    at = F.floor(F.col("start") / scope)
    asks = weak.withColumn("bin", F.explode(F.array(at - 1, at, at + 1)))
    near = F.abs(F.col("p") - F.col("start")) <= scope
    other = (F.col("q") <= F.col("start")) | (F.col("p") >= F.col("end"))
    met = asks.join(partners, ["row_id", "role", "bin"]).filter(near & other)
    of = lambda role, value: F.when(F.col("role") == role, F.col(value))
    ends = met.groupBy("row_id", "start", "rank", "kind", "end").agg(
        *[x for r in ("secret", "identifier") for x in (F.min(of(r, "q")).alias(f"{r}_ends"), F.max(of(r, "p")).alias(f"{r}_begins"))]
    )
    # Two of different roles that do not overlap: the first to end does so before the last of the other role begins.
    both = F.coalesce(F.col("secret_ends") <= F.col("identifier_begins"), F.lit(False)) | F.coalesce(
        F.col("identifier_ends") <= F.col("secret_begins"), F.lit(False)
    )
    return (
        ends.filter((F.col("kind") != "endpoint") | both)
        .groupBy("row_id")
        .agg(F.collect_list(F.struct("start", "rank", "kind", "end")).alias("weak"))
    )


def _apart(every: DataFrame, scope: int) -> DataFrame:
    """The parts without weak ones that overlap a part that says more; both meet in the bins they cover."""
    covered = F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor((F.col("end") - 1) / scope))).alias("bin")
    more = F.create_map(*[x for k, kinds in SAYS_MORE.items() for x in (F.lit(k), F.array(*map(F.lit, kinds)))])[F.col("kind")]
    less = every.filter(F.col("kind").isin(*SAYS_MORE)).select("*", covered, more.alias("more"))
    others = every.filter(F.col("kind") != "key").select(
        F.col("row_id"), covered, F.col("kind").alias("by"), F.col("start").alias("p"), F.col("end").alias("q")
    )
    over = F.array_contains("more", F.col("by")) & (F.col("p") < F.col("end")) & (F.col("start") < F.col("q"))
    lost = less.join(others, ["row_id", "bin"]).filter(over).select("row_id", "start", "rank").distinct()
    return every.join(lost, ["row_id", "start", "rank"], "left_anti")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """Per document: doc_id, base (spans of the three kinds), weak (linked parts), each an
    array of (start, rank, kind, end) in order of place."""
    spark = docs.sparkSession
    path = fresh_path(spark, "parts")
    parts(docs, id_col, text_col).write.parquet(path)
    found = spark.read.parquet(path)
    weak = linked(found, scope)
    base = F.array_sort(F.concat(*[F.col(k) for k in BASE]))
    return found.join(weak, "row_id", "left").select(
        "doc_id", base.alias("base"), F.coalesce(F.array_sort("weak"), F.array().cast(TAG)).alias("weak"), *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE]
    )


def report(found: DataFrame) -> DataFrame:
    """The scan as counts, a digest of the base spans, and all spans as text."""
    return found.select(
        "doc_id",
        *[f"n_{k}" for k in BASE],
        F.sha2(joined_text(F.col("base")), 256).alias("base_sha256"),
        joined_text(F.array_sort(F.concat("base", "weak"))).alias("spans"),
    )
