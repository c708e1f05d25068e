"""The registered queries of this folder, and SQL where it can express them."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import (
    align, decontaminate, exact_dedup, maxent, mixing, periodic, pii, secrets, simhash, token_files, toxicity, vector_forest, warc,
)

Query = Callable[[SparkSession, str], DataFrame]


ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where it lies.

    On a cluster it is installed or sent along with the job, and the path means nothing.
    """
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, how likely it is labelled toxic."""
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    found = toxicity.classify(docs, labels)
    return found.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op2_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, the secrets in it."""
    return secrets.report(secrets.scan(_table(spark, folder, "documents")))


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, the copy that stays."""
    return exact_dedup.mark_copies(_table(spark, folder, "documents"))


OP3_SQL = """
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(body) AS text_sha256
FROM (
  SELECT doc_id, body, max(doc_id) OVER (PARTITION BY body) AS keep_id,
         count(*) OVER (PARTITION BY body) AS group_size
  FROM (SELECT doc_id, coalesce(text, '') AS body FROM documents))
"""


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Per page, its record as read back from the archives."""
    back = warc.round_trip(_table(spark, folder, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = """
SELECT page_id, payload_bytes,
       translate(to_base(('0x' || sha[1:10])::BIGINT, 32, 8) || to_base(('0x' || sha[11:20])::BIGINT, 32, 8)
                 || to_base(('0x' || sha[21:30])::BIGINT, 32, 8) || to_base(('0x' || sha[31:40])::BIGINT, 32, 8),
                 '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM (
  SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha1(body) AS sha,
         min(page_id) OVER (PARTITION BY body) AS first
  FROM (SELECT page_id, coalesce(html, '') AS body FROM pages))
"""


def op5_maxent(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, its log-probability under two models of the corpus."""
    return maxent.score(_table(spark, folder, "documents"))


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, its fingerprint and its component."""
    return simhash.components(_table(spark, folder, "documents"))


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, how much of it is benchmark text."""
    found = decontaminate.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


OP7_SQL = """
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
phrases AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS phrase
  FROM items, unnest(range(1, greatest(2, len(w) - 11))) AS u(i) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM phrases),
grams AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM docs, lengths, unnest(range(1, len(w) - n + 2)) AS u(i)),
hits AS (SELECT r, g.n, i, item_id FROM grams g JOIN phrases p ON g.n = p.n AND g.phrase = p.phrase),
words AS (SELECT r, count(DISTINCT j) AS n_hit FROM hits, unnest(range(i, i + n)) AS u(j) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM hits) GROUP BY r)
SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(w), 0) AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN named USING (r)
"""


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, its token ids as read back from the files."""
    return token_files.round_trip(_table(spark, folder, "documents"))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, how many of its words the mix takes."""
    found = mixing.mix(_table(spark, folder, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, the personal data in it."""
    return pii.report(pii.scan(_table(spark, folder, "documents")))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, the periodic runs of its words and the text without their repetitions."""
    found = periodic.find_runs(periodic.planted(_table(spark, folder, "documents")))
    best = periodic.longest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_align(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, the groups of its tokens in two tokenizers and how common their links are."""
    found = align.align(_table(spark, folder, "documents"), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


def op13_vector_forest(spark: SparkSession, folder: str) -> DataFrame:
    """Per vector, its near copies and their component."""
    return vector_forest.near_copies(_table(spark, folder, "embeddings"))


def registered() -> dict[str, Query]:
    """Every query of this folder by name."""
    found = (
        op1_toxicity, op2_secrets, op3_exact_dedup, op4_warc, op5_maxent, op6_simhash, op7_decontaminate, op8_token_files, op9_mixing,
        op10_pii, op11_periodic_runs, op12_align, op13_vector_forest,
    )
    return {f.__name__: f for f in found}


def statements() -> dict[str, str]:
    """SQL with the same rows, where SQL can express the query."""
    return {"op3_exact_dedup": OP3_SQL, "op4_warc": OP4_SQL, "op7_decontaminate": OP7_SQL}
