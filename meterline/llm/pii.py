"""Personal data: plain patterns, and identifiers found by the company they keep.

Four kinds are reported wherever they match: e-mail addresses, IP addresses, payment
cards and phone numbers. They are also the seeds of a bootstrap. Every token with a digit
or an at sign is an *instance*, seen with a lexical *pattern*, the two words on its left, if
no other token stands between. The
graph of patterns and instances is scored over all documents:

* an instance starts with the share of its tokens that a seed covers (0 or 1 as a rule);
* a pattern's confidence is the mean score of what it introduces, weighted by tokens and
  drawn towards zero by ``PRIOR`` tokens that never were seeds;
* an instance's next score is the larger of its start and the weighted mean confidence of
  its patterns, damped; what a confident pattern with enough distinct instances introduces
  scores 1, as a seed does, and so leads to further patterns.

After ``ROUNDS`` rounds without a new such pattern, the tokens that a confident pattern with enough distinct
instances introduces are reported as kind ``found`` if no plain match covers them. A token that as a
whole matches a plain kind and fails its check (a card number whose digits do not add up) is
known not to be of that kind, and is reported only after a pattern that introduces several such
tokens and whose seeds are mostly of other kinds. A failed match in a part of a token says
nothing about the token.

Both steps of a round group by pattern or by instance, combined inside tasks first, and
work on edges that carry counts, so a pattern as common as any costs one row per instance.

Defined cases: a null text counts as empty; a null id is an id like any other; rows that
repeat an id and text each give a row, with equal results; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.spans import joined_text, let, tagged, with_matches
from meterline.scratch import fresh_path

# The patterns of the four kinds, in the order of reports.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
IP = rf"^{PART}(?:\.{PART}){{3}}$"
CARD_DIGITS = (13, 19)
PHONE_DIGITS = (9, 15)

# A token with a digit or an at sign; what it is a token of ends at white space or a mark.
TOKEN = r"(?<![^\s\"'()\[\]<>|,;])[^\s\"'()\[\]<>|,;0-9@]*+[0-9@][^\s\"'()\[\]<>|,;]*+"
LEFT_WORDS = r"(\S+\s+\S+)\s+[\"'(\[<|,;]*$"
LEAST_LENGTH = 5

ROUNDS = 3
DAMPING = 0.5
PRIOR = 1.0
CONFIDENT = 0.6
LEAST_INSTANCES = 3

TAG = "array<struct<start:int,rank:int,kind:string,end:int>>"


NOT_REFUSED = "(failed IS NULL OR array_contains(allowed, failed))"


def luhn(text: Column) -> Column:
    """Whether the digits of a text pass the Luhn check."""
    digits = F.reverse(F.filter(F.split(text, ""), lambda c: c.between("0", "9")))
    doubled = F.transform(
        digits, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c >= "5", 9).otherwise(0))
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _digits(value: Column) -> Column:
    return F.length(F.regexp_replace(value, "[^0-9]", ""))


def mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, row_id (of id and text), the places of the four kinds, and
    tokens, an array of (start, end, instance, pattern, seed, kind, failed): the kind that
    covers a part of it, and the kind whose failed match covers all of it."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("row_id", F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("~")), "text")))
    rows = rows.withColumn("marked", F.col("text").rlike("[0-9@]"))
    gate = {"email": F.col("text").contains("@"), "phone": F.col("text").contains("+")}
    gate |= {k: F.col("marked") for k in ("ip", "card", "token")}
    found = with_matches(rows, "text", BASE | {"token": TOKEN}, gate)
    found = found.withColumn("tried", F.concat(*[tagged(k, i, F.col(k)) for i, k in enumerate(BASE)]))
    found = found.withColumns(
        {
            "ip": F.filter("ip", lambda s: s["value"].rlike(IP)),
            "card": F.filter("card", lambda s: (_digits(s["value"]).between(*CARD_DIGITS)) & luhn(s["value"])),
            "phone": F.filter("phone", lambda s: _digits(s["value"]).between(*PHONE_DIGITS)),
        }
    )
    found = found.withColumns({k: tagged(k, i, F.col(k)) for i, k in enumerate(BASE)}).withColumn("base", F.concat(*BASE))
    return found.select("doc_id", "row_id", *BASE, _tokens(F.col("token"), F.col("base"), F.col("tried")).alias("tokens"))


def _tokens(tokens: Column, base: Column, tried: Column) -> Column:
    def one(t: Column, all_spans: Column) -> Column:
        value = F.regexp_replace(t["value"], r"[.:!?]+$", "")
        left = F.lower(F.regexp_extract(t["left"], LEFT_WORDS, 1))
        end = t["start"] + F.length(value)
        met = F.filter(all_spans["base"], lambda b: (b["start"] < end) & (t["start"] < b["end"]))
        within = F.filter(all_spans["tried"], lambda b: (b["start"] <= t["start"]) & (end <= b["end"]))
        kind, failed = (F.try_element_at(x, F.lit(1))["kind"] for x in (met, within))
        return F.struct(
            t["start"].alias("start"), end.alias("end"), value.alias("instance"),
            F.regexp_replace(left, r"\s+", " ").alias("pattern"), kind.isNotNull().alias("seed"), kind.alias("kind"),
            F.when(kind.isNull(), failed).alias("failed"),
        )

    told = F.filter(tokens, lambda t: F.length(t["value"]) >= LEAST_LENGTH)
    made = let(F.struct(base.alias("base"), tried.alias("tried")), lambda b: F.transform(told, lambda t: one(t, b)))
    return F.filter(made, lambda t: (F.length(t["instance"]) >= LEAST_LENGTH) & (F.length(t["pattern"]) > 0))


def confident_patterns(
    found: DataFrame, rounds: int = ROUNDS, confident: float = CONFIDENT, least: int = LEAST_INSTANCES
) -> DataFrame:
    """(pattern, confidence, allowed) of the patterns whose tokens are to be reported, even those
    that failed as one of the kinds allowed."""
    spark = found.sparkSession

    def kept(frame: DataFrame, name: str) -> DataFrame:
        path = fresh_path(spark, name)
        frame.write.parquet(path)
        return spark.read.parquet(path)

    seen = found.select(F.explode("tokens").alias("t")).select("t.*")
    edges = kept(
        seen.groupBy("pattern", "instance").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("seed").cast("long")).alias("seeds"), F.max("kind").alias("kind"), F.max("failed").alias("failed")),
        "edges",
    )
    starts = edges.groupBy("instance").agg((F.sum("seeds") / F.sum("n")).alias("start"))
    scored = edges.join(starts, "instance").withColumn("score", F.col("start"))
    allowed = F.array_compact(
        F.array(
            *[
                F.when(
                    (F.count_if(F.col("failed") == k) >= least)
                    & (2 * F.sum(F.when(F.col("kind") == k, F.col("seeds")).otherwise(0)) <= F.sum("seeds")),
                    F.lit(k),
                )
                for k in BASE
            ]
        )
    )
    good = (F.col("confidence") >= confident) & (F.col("instances") >= least)
    count = quiet = 0
    while quiet < rounds:
        # Scores never fall, so a good pattern stays one and the rounds end.
        scored = kept(scored, "scored")
        patterns = scored.groupBy("pattern").agg(
            (F.sum(F.col("n") * F.col("score")) / (F.sum("n") + PRIOR)).alias("confidence"),
            F.count(F.lit(1)).alias("instances"), allowed.alias("allowed"),
        )
        patterns = kept(patterns.withColumn("good", good), "patterns")
        before, count = count, patterns.filter("good").count()
        quiet = quiet + 1 if count == before else 0
        judged = scored.join(patterns, "pattern")
        fresh = judged.groupBy("instance").agg(
            F.greatest(
                F.first("start"), DAMPING * F.sum(F.col("n") * F.col("confidence")) / F.sum("n"),
                F.max(F.col("good") & F.expr(NOT_REFUSED)).cast("double"),
            ).alias("score")
        )
        scored = scored.drop("score").join(fresh, "instance")
    return patterns.filter("good").select("pattern", "confidence", "allowed")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, base and found, each an array of (start, rank, kind, end), and
    the number of each plain kind."""
    spark = docs.sparkSession
    path = fresh_path(spark, "mentions")
    mentions(docs, id_col, text_col).write.parquet(path)
    found = spark.read.parquet(path)
    unseen = found.select("row_id", F.explode("tokens").alias("t")).select("row_id", "t.*").filter("NOT seed").distinct()
    more = (
        unseen.join(confident_patterns(found), "pattern")
        .filter(NOT_REFUSED)
        .groupBy("row_id")
        .agg(
            F.collect_list(
                F.struct("start", F.lit(len(BASE)).alias("rank"), F.lit("found").alias("kind"), F.col("end").alias("end"))
            ).alias("found")
        )
    )
    base = F.concat(*[F.array_sort(F.col(k)) for k in BASE])
    return found.join(more, "row_id", "left").select(
        "doc_id", base.alias("base"), F.coalesce(F.array_sort("found"), F.array().cast(TAG)).alias("found"),
        *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
    )


def report(found: DataFrame) -> DataFrame:
    """The scan as counts, a digest of the plain spans, and all spans as text."""
    return found.select(
        "doc_id",
        *[f"n_{k}" for k in BASE],
        F.sha2(joined_text(F.col("base")), 256).alias("base_sha256"),
        joined_text(F.concat("base", "found")).alias("spans"),
    )
