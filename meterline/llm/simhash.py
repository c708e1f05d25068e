"""Near copies by SimHash fingerprints and multi-index hashing.

A fingerprint is cut into ``bits // 2 + 1`` segments. Two fingerprints that differ in at
most ``bits`` bits differ in at most one bit of some segment, so each one probes, in the
table of every segment, its own segment value and the values one bit away. Only the half
of that ball with a bit *added* is probed: of two values one bit apart exactly one gets
there. What the tables return is checked over the whole fingerprint.

Equal fingerprints collapse before the search, so a group of copies is one entry however
large it is. No partner is capped; a crowded segment value is a skewed join key, which
adaptive execution splits.

Defined cases: a text without words (null, empty, blanks) has fingerprint zero and links
like any other; fewer words than a shingle make one shingle; rows that repeat an id each
give a row; a null id never names a component, unless the component has no other; an
empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.links import roots
from meterline.scratch import fresh_path

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
BLOCK = 1 << 14


def fingerprint(text: str | None, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """The signed 64-bit fingerprint of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words_per_shingle, len(words))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())
    hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], dtype=np.uint64)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), BLOCK):
        raw = hashes[at : at + BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes))
    return int(bits.view(">i8")[0])


def _print(text: Column, words: int) -> Column:
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    return F.pandas_udf(prints, "long")(text)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp), one row per document."""
    return docs.select(F.col(id_col).alias("doc_id"), _print(F.col(text_col), words).alias("fp"))


def links(prints: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """(a, b) for all different fingerprints in column fp at most ``bits`` bits apart."""
    count = bits // 2 + 1
    width = -(-64 // count)
    cut = []
    for i in range(count):
        part = F.shiftrightunsigned(F.col("fp"), i * width)
        size = min(width, 64 - i * width)
        cut.append(F.struct(F.lit(i).alias("seg"), F.lit(size).alias("size"), (part.bitwiseAND((1 << size) - 1) if size < 64 else part).alias("key")))
    table = prints.select("fp", F.explode(F.array(*cut)).alias("s")).select("fp", "s.*")
    ball = F.expr(
        "concat(array(key), transform(filter(sequence(0, size - 1), i -> (shiftright(key, i) & 1) = 0), i -> key | shiftleft(1L, i)))"
    )
    probes = table.select("seg", F.col("key").alias("own"), F.col("fp").alias("a"), F.explode(ball).alias("key"))
    found = probes.join(table.select("seg", "key", F.col("fp").alias("b")), ["seg", "key"])
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits
    once = (F.col("own") != F.col("key")) | (F.col("a") < F.col("b"))
    return found.filter(close & once).select("a", "b")


def _rooted(rows: DataFrame, least: Column, bits: int) -> DataFrame:
    """(fp, least, root) per fingerprint of rows: the least of its rows, and its component's fingerprint."""
    nodes = rows.groupBy("fp").agg(F.min(least).alias("least"))
    root = roots(links(nodes.select("fp"), bits))
    return nodes.join(root.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, bits: int = MAX_BITS) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id (least id reachable)."""
    spark = docs.sparkSession
    path = fresh_path(spark, "fingerprints")
    fingerprints(docs, id_col, text_col, words).write.parquet(path)
    rows = spark.read.parquet(path)
    rooted = _rooted(rows, F.col("doc_id"), bits)
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = rooted.join(names, "root").select("fp", "component_id")
    return rows.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, bits: int = MAX_BITS) -> DataFrame:
    """Of each component one row: the least id, a null one last; of rows that repeat it, the least by a hash of the row."""
    spark = docs.sparkSession
    path, where = fresh_path(spark, "documents"), fresh_path(spark, "fingerprints")
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if not re.search("map<|variant", f.dataType.simpleString())]
    # Written once, so a row has one key however often the table is read.
    docs.select(F.struct("*").alias("doc"), F.xxhash64(*hashed).alias("turn"), F.monotonically_increasing_id().alias("row")).write.parquet(path)
    held = spark.read.parquet(path)
    held.select(
        F.col(f"doc.`{id_col}`").alias("doc_id"), "turn", "row", _print(F.col(f"doc.`{text_col}`"), words).alias("fp")
    ).write.parquet(where)
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "turn", "row")
    first = _rooted(spark.read.parquet(where), order, bits).groupBy("root").agg(F.min("least").alias("first"))
    return held.join(first.select(F.col("first.row").alias("row")), "row", "left_semi").select("doc.*")
