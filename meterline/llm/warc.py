"""WARC archives written and read by Spark, with records found by their boundary chain.

Archives are text files whose line separator is the blank line pair that ends a record,
so Spark's own committer writes them and any file system it knows can hold them. Reading
splits plain files anywhere: the record magic is the line separator, so every task gets the
pieces between two magics of its splits, and each piece is a *candidate* record. From the
lengths in its head a task works out where the next record would start. Magic inside a
payload gives candidates as well. Which ones are records is settled by pointer jumping:
from the start of each file the reached set doubles with every round, and only candidates
on that chain are records. A payload that holds the magic is put together again from its
pieces.

Defined cases: a null payload counts as empty, a null or odd address is left out or
escaped; a null id is never the first of its payload; rows that repeat an id and payload
each give a record; an empty table gives an empty archive and no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import or_
from typing import Literal
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterline.scratch import fresh_path

# Fixed values of the format.
MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

BIN = 1 << 20
FILE_RECORDS = 50_000
TOLD = 5  # breaks that an error names

RECORDS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
)
PIECES = (
    "file string, block long, rel long, size long, span long, whole boolean, "
    f"{RECORDS}, stated_digest string"
)


def sha1_base32(text: Column) -> Column:
    """The SHA-1 of a text's UTF-8 bytes in upper-case base32."""
    digest = F.sha1(F.encode(text, "UTF-8"))
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*parts)), DIGITS, BASE32)


def with_first(pages: DataFrame, id_col: str, text_col: str, url_col: str, least_bytes: int) -> DataFrame:
    """Rows (page_id, url, body, digest, bytes, first): the least id among equal payloads.

    The groups are dealt out by salt, so a payload that a third of all pages share meets
    its first id in many tasks.
    """
    salts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    body = F.coalesce(F.col(text_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        body.alias("body"),
        sha1_base32(body).alias("digest"),
        F.octet_length(body).cast("long").alias("bytes"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts)).cast("int").alias("salt"),
    )
    salted = rows.groupBy("digest", "bytes", "salt").agg(F.min("page_id").alias("least"))
    least = salted.groupBy("digest", "bytes").agg(F.min("least").alias("first"), F.collect_set("salt").alias("salts"))
    dealt = least.select("digest", "bytes", "first", F.explode("salts").alias("salt"))
    return rows.join(dealt, ["digest", "bytes", "salt"]).withColumn(
        "first", F.when(F.col("bytes") >= least_bytes, F.col("first"))
    )


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", text_col: str = "html", url_col: str = "url", least_bytes: int = 0, codec: str = "gzip"
) -> None:
    """One record per page; pages whose payload an earlier id has become revisits of it.

    Files hold at most ``FILE_RECORDS`` records. Compressed ones are read by one task each,
    plain ones (codec ``none``) are split anywhere.
    """
    rows = with_first(pages, id_col, text_col, url_col, least_bytes)
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit(END),
    )
    url = F.regexp_replace(F.col("url"), r"[\x00-\x20\x7F]", "%20")
    head = F.concat(
        F.lit("WARC-Type: "), F.when(again, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "), name("page_id"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), url), F.lit("")),
        F.lit("\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(again, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), name("first"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + F.when(again, F.lit(0)).otherwise(F.col("bytes"))).cast("string"),
    )
    record = F.concat(F.lit(MAGIC), head, F.lit(END), http, F.when(again, F.lit("")).otherwise(F.col("body")))
    rows.select(record.alias("record")).write.options(lineSep=END, compression=codec, maxRecordsPerFile=FILE_RECORDS).text(path)


def _page(name: str | None) -> int | None:
    digits = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits.lstrip("-").isdigit() else None


def parse(piece: str) -> tuple | None:
    """What follows the magic, as (span in bytes, whole, record fields, stated digest).

    None if it has no head of a record. A record is whole if the piece holds all its block;
    otherwise only its span is known.
    """
    head, blank, block = piece.partition(END)
    fields = dict(line.partition(": ")[::2] for line in head.split("\r\n"))
    length = fields.get("Content-Length", "")
    kind = fields.get("WARC-Type")
    if not blank or not (length.isascii() and length.isdigit()) or kind is None:
        return None
    raw, size = block.encode("utf-8", "surrogatepass"), int(length)
    span = len(MAGIC) + len(head.encode("utf-8", "surrogatepass")) + len(END) + size + len(END)
    if len(raw) < size:
        return span, False, (None,) * 5, None
    http, _, payload = raw[:size].partition(END.encode())
    stated = fields.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None
    if kind == "revisit":
        tell = http.rpartition(b"Content-Length: ")[2]
        count, digest = (int(tell) if tell.isdigit() else None), stated
    else:
        count, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return span, True, (_page(fields.get("WARC-Record-ID")), count, digest, kind, _page(fields.get("WARC-Refers-To"))), stated


def _raw_pieces(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", MAGIC).text(path)
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _offsets(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[int], list[int]]]:
    """Each frame with its pieces' starts, relative to the first of their split, and sizes."""
    split, at = None, 0
    for frame in frames:
        starts, sizes = [], []
        for value, file, block in zip(frame["value"], frame["file"], frame["block"]):
            if (file, block) != split:
                split, at = (file, block), 0
            size = len(value.encode("utf-8", "surrogatepass"))
            starts.append(at)
            sizes.append(size)
            at += size + len(MAGIC)
        yield frame, starts, sizes


def _candidates(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in PIECES.split(", ")]
    for frame, starts, sizes in _offsets(frames):
        rows = []
        for value, file, block, rel, size in zip(frame["value"], frame["file"], frame["block"], starts, sizes):
            found = parse(value) or (None, False, (None,) * 5, None)
            rows.append((file, block, rel, size, found[0], found[1], *found[2], found[3]))
        out = pd.DataFrame(rows, columns=names)
        for c in ("span", "page_id", "payload_bytes", "refers_to"):
            out[c] = out[c].astype("Int64")
        yield out


def _texts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame, starts, _ in _offsets(frames):
        yield frame.assign(rel=starts)


def _reassembled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = [(at, *parse(text)[2:]) for at, text in zip(frame["at"], frame["text"])]
        flat = [(at, *fields, stated) for at, fields, stated in rows]
        out = pd.DataFrame(flat, columns=["at", *[c.split()[0] for c in RECORDS.split(", ")], "stated_digest"])
        for c in ("page_id", "payload_bytes", "refers_to"):
            out[c] = out[c].astype("Int64")
        yield out


def _split_starts(pieces: DataFrame) -> DataFrame:
    """Per split (file, block): base, where its first piece starts, and stop, where its file
    ends. Files lie one behind the other in one address space, in order of their names.
    One row per split is what is ordered in a single task."""
    sizes = pieces.groupBy("file", "block").agg(F.sum(F.col("size") + len(MAGIC)).alias("n"))
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # The last piece of a file has no magic behind it.
    stop = F.max(F.col("base") + F.col("n")).over(Window.partitionBy("file")) - len(MAGIC)
    return placed.select("file", "block", "base", stop.alias("stop"))


def _placed(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """Rows of (file, block, rel) with ``at``, the address of their candidate's magic."""
    placed = rows.join(starts, ["file", "block"]).withColumn("at", F.col("base") + F.col("rel") - len(MAGIC))
    first = (F.col("rel") == 0) & (F.col("block") == 0)  # stands before any magic of its file
    return placed.filter(~first)


def reached(links: DataFrame) -> DataFrame:
    """(at) of the candidates on a chain from a row marked first; links are (at, to, first).

    Every round joins the reached set with jumps of 1, 2, 4, ... records, and the jumps
    with themselves. Tables of two numbers a candidate, written between rounds.
    """
    spark = links.sparkSession

    def kept(frame: DataFrame, name: str) -> DataFrame:
        path = fresh_path(spark, name)
        frame.write.parquet(path)
        return spark.read.parquet(path)

    links = kept(links, "links")
    found = links.filter("first").select("at")
    jumps = links.select("at", "to")
    while not jumps.isEmpty():
        # One table a round: what is reached by a jump, and all reached so far stays in the tables before.
        fresh = kept(found.join(jumps, "at").select(F.col("to").alias("at")), "reached")
        found = found.unionAll(fresh)
        later = jumps.select(F.col("at").alias("to"), F.col("to").alias("beyond"))
        jumps = kept(jumps.join(later, "to").select("at", F.col("beyond").alias("to")), "jumps")
    return found


class DamagedArchive(ValueError):
    """Archives whose chain of records breaks; ``places`` has (file, byte offset) of up to ``TOLD`` of them."""

    def __init__(self, places: list[tuple[str, int]]):
        super().__init__("; ".join(f"{file}: no whole record at byte {at}" for file, at in places))
        self.places = places


def _breaks(candidates: DataFrame, chain: DataFrame, starts: DataFrame) -> list[tuple[str, int]]:
    """Where the chains of files end before the files do: a record that points to no record, or beyond the end."""
    files = starts.groupBy("file").agg(F.min("base").alias("base"), F.max("stop").alias("stop")).filter("stop > base")
    held = candidates.select("at", (F.col("at") + F.col("span") <= F.col("stop")).alias("inside"))
    lost = chain.join(held, "at", "left").filter(~F.coalesce("inside", F.lit(False))).select("at")
    lost = lost.join(files.select(F.col("stop").alias("at")), "at", "left_anti")
    # A file that does not begin with a record has no first candidate.
    headless = files.join(candidates.filter("block = 0").filter(F.col("rel") == len(MAGIC)).select("file"), "file", "left_anti").select(F.col("base").alias("at"))
    places = [r["at"] for r in lost.unionAll(headless).orderBy("at").limit(TOLD).collect()]
    if not places:
        return []
    told = files.filter(reduce(or_, [(F.col("base") <= at) & (F.col("stop") > at) for at in places])).collect()
    return [(r["file"], at - r["base"]) for at in places for r in told if r["base"] <= at < r["stop"]]


def read_archives(spark: SparkSession, path: str, damaged: Literal["raise", "skip"] = "raise") -> DataFrame:
    """The records of the archives below path: page_id, payload_bytes, payload_digest,
    record_type, refers_to, and whether the digest stated in the head is that of the payload.

    The chain of every file has to end where the file does. Where one breaks, for the file was
    cut or changed, :class:`DamagedArchive` tells the places, or with "skip" the whole records
    before the break are returned. A record that is not whole is never a row.
    """
    where = fresh_path(spark, "candidates")
    _raw_pieces(spark, path).mapInPandas(_candidates, PIECES).write.parquet(where)
    pieces = spark.read.parquet(where)
    starts = _split_starts(pieces)

    candidates = _placed(pieces, starts).filter("span IS NOT NULL")
    # A file begins with the magic, so the first candidate of its first split is its first record.
    first = (F.col("block") == 0) & (F.col("rel") == len(MAGIC))
    links = candidates.filter(F.col("at") + F.col("span") <= F.col("stop")).select(
        "at", (F.col("at") + F.col("span")).alias("to"), first.alias("first")
    )
    chain = reached(links)
    if damaged == "raise" and (places := _breaks(candidates, chain, starts)):
        raise DamagedArchive(places)
    fields = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "stated_digest"]
    where = fresh_path(spark, "records")
    inside = F.col("at") + F.col("span") <= F.col("stop")
    candidates.filter(inside).join(chain, "at").select("at", "span", "whole", *fields).write.parquet(where)
    records = spark.read.parquet(where)
    out = records.filter("whole").select(*fields)

    cut = records.filter("NOT whole").select("at", "span")
    if not cut.isEmpty():
        raw = _raw_pieces(spark, path).mapInPandas(_texts, "value string, file string, block long, rel long")
        texts = _placed(raw, starts).select(F.col("at").alias("piece"), "value", F.floor(F.col("at") / BIN).alias("bin"))
        bins = F.sequence(F.floor(F.col("at") / BIN), F.floor((F.col("at") + F.col("span")) / BIN))
        inside = (F.col("piece") >= F.col("at")) & (F.col("piece") < F.col("at") + F.col("span"))
        joined = (
            cut.withColumn("bin", F.explode(bins))
            .join(texts, "bin")
            .filter(inside)
            .groupBy("at")
            .agg(F.array_sort(F.collect_list(F.struct("piece", "value"))).alias("parts"))
            .select("at", F.array_join(F.col("parts.value"), MAGIC).alias("text"))
        )
        again = joined.mapInPandas(_reassembled, f"at long, {RECORDS}, stated_digest string")
        out = out.unionByName(again.select(*fields))
    return out.select(*fields[:5], F.coalesce(F.col("stated_digest") == F.col("payload_digest"), F.lit(False)).alias("digest_holds"))


def round_trip(pages: DataFrame, id_col: str = "page_id", text_col: str = "html", url_col: str = "url", least_bytes: int = 0, codec: str = "gzip") -> DataFrame:
    """Write the pages to fresh archives in the shared folder and read them back."""
    spark = pages.sparkSession
    path = fresh_path(spark, "archives")
    write_archives(pages, path, id_col, text_col, url_col, least_bytes, codec)
    return read_archives(spark, path)
