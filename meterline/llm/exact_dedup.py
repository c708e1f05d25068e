"""Exact copies of texts, found without bringing a large group into one task.

Skew-safe combining in three steps, each of which groups by digest *and* full text, so
that two texts of one digest never merge:

1. inside each task, rows of equal (digest, salt, text) collapse before any shuffle;
2. the salted groups merge, so a text that fills a third of the table is dealt out over
   as many tasks as there are salts;
3. the winners of the salts, at most one row per salt and text, merge globally.

Rows then learn their winner by (digest, salt) without their texts being moved again.
Only where a digest turns out to stand for several texts do the rows of that digest meet
the winners by text.

Defined cases: a null text counts as empty; a null id ranks below every other and stays
only if the group has no other; rows that repeat an id give a row each, with equal
results; an empty table gives an empty result; other columns are ignored, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.scratch import fresh_path


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def mark_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256_hex,
    salts: int | None = None,
) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256; the largest id stays.

    ``digest`` only decides which texts are compared; any function gives the same result.
    ``salts`` (the session's number of shuffle partitions) is how many ways a group is dealt.
    """
    spark = docs.sparkSession
    salts = salts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        text.alias("text"),
        digest(text).alias("digest"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts)).cast("int").alias("salt"),
    )
    salted = rows.groupBy("digest", "salt", "text").agg(F.max("doc_id").alias("top"), F.count(F.lit(1)).alias("n"))
    winners = salted.groupBy("digest", "text").agg(
        F.max("top").alias("keep_id"), F.sum("n").alias("group_size"), F.collect_set("salt").alias("salts")
    )
    by_digest = winners.groupBy("digest").agg(
        F.count(F.lit(1)).alias("texts"),
        F.max("keep_id").alias("keep_id"),
        F.max("group_size").alias("group_size"),
        F.array_distinct(F.flatten(F.collect_list("salts"))).alias("salts"),
    )
    path = fresh_path(spark, "copies")
    by_digest.write.parquet(path)
    known = spark.read.parquet(path)

    plain = known.filter("texts = 1").select("digest", F.explode("salts").alias("salt"), "keep_id", "group_size")
    slim = rows.withColumn("text_sha256", F.sha2("text", 256)).drop("text")
    marked = slim.join(plain, ["digest", "salt"]).select("doc_id", "keep_id", "group_size", "text_sha256")

    several = known.filter("texts > 1").select("digest")
    if not several.isEmpty():
        by_text = winners.join(several, "digest", "left_semi").select("digest", "text", "keep_id", "group_size")
        apart = rows.join(several, "digest", "left_semi").join(by_text, ["digest", "text"])
        marked = marked.unionByName(apart.select("doc_id", "keep_id", "group_size", F.sha2("text", 256).alias("text_sha256")))
    return marked.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )

