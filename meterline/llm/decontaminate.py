"""Benchmark passages in documents, found with an FM-index per shard of documents.

A task lays its documents' words out as whole numbers, ``SHARD`` words to a shard, sorts
the suffixes (prefix doubling; only suffixes that still tie are sorted again), and keeps
the Burrows-Wheeler transform in a wavelet matrix, with the position of every ``EVERY``-th
word and of every document's first word. Shards are rows of a table in the shared folder;
no document is shuffled.

Benchmark windows are searched backwards, all windows of a block at once: each word
narrows the row ranges by two ranks. Rows found are walked back to the next sampled
position, and the word spans of a document merge. Blocks hold ``BLOCK`` windows, so what
is sent to the tasks is bounded however large the benchmark is; each block is searched in
every shard.

Defined cases: a null text, in either table, has no words; an item of fewer words than a
window is one window, one without words none; items that repeat count by their id; items
without an id are searched like others and stand in ``items`` as one null;
rows that repeat a document id give a row each; empty tables give rows without hits, or no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.wavelet import BitPlane, WaveletMatrix
from meterline.scratch import fresh_path

WINDOW = 13
SHARE = 20  # contaminated: at least one word in so many is hit
SHARD = 1 << 20
EVERY = 16
BLOCK = 1 << 17

KEEP = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
SMALL = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SHARDS = "shard long, doc_ids binary, absent binary, starts binary, index binary"
HITS = "shard long, ordinal long, spans array<struct<first:long,stop:long>>, items array<string>"


def words(text: str | None) -> list[bytes]:
    """Lower-cased words in UTF-8: runs of digits, ASCII letters and anything beyond ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(KEEP).split()


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order. Zeros end documents; each is its own symbol, in order of place."""
    n = len(symbols)
    zeros = symbols == 0
    first = symbols.astype(np.int64) + np.count_nonzero(zeros)
    first[zeros] = np.arange(np.count_nonzero(zeros))
    sa = np.argsort(first, kind="stable")
    keys = first[sa]
    begins = np.empty(n, dtype=bool)
    begins[:1], begins[1:] = True, keys[1:] != keys[:-1]
    rank = np.empty(n, dtype=np.int64)
    rank[sa] = np.maximum.accumulate(np.where(begins, np.arange(n), 0))
    ties = ~begins
    ties[:-1] |= ~begins[1:]
    places, ahead = np.flatnonzero(ties), 1
    while len(places):
        some = sa[places]
        keys = rank[some] << 32 | rank[some + ahead]
        order = np.argsort(keys)
        some, keys = some[order], keys[order]
        sa[places] = some
        begins = np.empty(len(keys), dtype=bool)
        begins[0], begins[1:] = True, keys[1:] != keys[:-1]
        rank[some] = np.maximum.accumulate(np.where(begins, places, 0))
        ties = ~begins
        ties[:-1] |= ~begins[1:]
        places, ahead = places[ties], ahead * 2
    return sa


class FMIndex:
    """Counts and places of word sequences in documents that were laid end to end."""

    def __init__(self, vocabulary: list[bytes], below: np.ndarray, matrix: WaveletMatrix, marks: BitPlane, samples: np.ndarray):
        self.vocabulary, self.below, self.matrix, self.marks, self.samples = vocabulary, below, matrix, marks, samples
        self.number = {w: i + 1 for i, w in enumerate(vocabulary)}

    @classmethod
    def of(cls, docs: list[list[bytes]]) -> tuple[FMIndex, np.ndarray]:
        """The index, and where each document starts; a zero stands behind each."""
        sizes = np.array([len(d) for d in docs], dtype=np.int64)
        ends = np.cumsum(sizes + 1)
        starts = ends - sizes - 1
        flat = np.array([w for d in docs for w in d], dtype=object)
        codes, vocabulary = pd.factorize(flat) if len(flat) else (np.zeros(0, dtype=np.int64), [])
        symbols = np.zeros(int(ends[-1]), dtype=np.int64)
        inner = np.ones(len(symbols), dtype=bool)
        inner[ends - 1] = False
        symbols[inner] = codes + 1
        sa = suffix_array(symbols)
        matrix = WaveletMatrix.of(symbols[sa - 1])
        below = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=len(vocabulary) + 1))))
        sampled = np.zeros(len(symbols), dtype=bool)
        sampled[::EVERY] = True
        sampled[starts] = True
        marked = sampled[sa]
        return cls(list(vocabulary), below, matrix, BitPlane.of(marked), sa[marked].astype(np.uint32)), starts

    def ranges(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of symbols, the rows [low, high) of suffixes that begin with it."""
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), self.matrix.size, dtype=np.int64)
        alive = np.flatnonzero((patterns > 0).all(axis=1))
        high[(patterns <= 0).any(axis=1)] = 0
        for step in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[alive, step]
            base = self.below[symbol] - self.matrix.down(symbol, np.zeros_like(symbol))
            low[alive] = base + self.matrix.down(symbol, low[alive])
            high[alive] = base + self.matrix.down(symbol, high[alive])
            alive = alive[low[alive] < high[alive]]
        dead = np.ones(len(patterns), dtype=bool)
        dead[alive] = False
        high[dead] = low[dead]
        return low, high

    def places(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes of these rows begin: back to a sampled word, counting steps."""
        out = np.empty(len(rows), dtype=np.int64)
        steps = np.zeros(len(rows), dtype=np.int64)
        todo, rows = np.arange(len(rows)), rows.copy()
        while len(todo):
            now = rows[todo]
            done = self.marks.get(now)
            out[todo[done]] = self.samples[self.marks.rank(now[done])].astype(np.int64) + steps[todo[done]]
            todo, now = todo[~done], now[~done]
            symbol, at = self.matrix.access(now)
            rows[todo] = self.below[symbol] + at - self.matrix.down(symbol, np.zeros_like(symbol))
            steps[todo] += 1
        return out

    def to_bytes(self) -> bytes:
        press = zstandard.ZstdCompressor(level=1).compress
        parts = [
            press(b" ".join(self.vocabulary)), press(self.below.astype("<i8").tobytes()), self.matrix.to_bytes(),
            press(self.marks.words.tobytes()), press(self.samples.astype("<u4").tobytes()),
        ]
        return struct.pack("<QQ5Q", self.matrix.size, len(self.vocabulary), *map(len, parts)) + b"".join(parts)

    @classmethod
    def from_bytes(cls, raw: bytes) -> FMIndex:
        size, _, *lengths = struct.unpack_from("<QQ5Q", raw)
        cuts = np.cumsum([struct.calcsize("<QQ5Q"), *lengths]).tolist()
        parts = [raw[a:b] for a, b in zip(cuts, cuts[1:])]
        loose = zstandard.ZstdDecompressor().decompress
        marks = BitPlane(np.frombuffer(loose(parts[3]), dtype="<u8"), size)
        return cls(
            loose(parts[0]).split(), np.frombuffer(loose(parts[1]), dtype="<i8"), WaveletMatrix.from_bytes(parts[2]), marks,
            np.frombuffer(loose(parts[4]), dtype="<u4"),
        )


def write_index(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", shard: int = SHARD) -> None:
    """One row per shard below path."""

    def pack(ids: list, docs: list[list[bytes]], number: int) -> pd.DataFrame:
        index, starts = FMIndex.of(docs)
        present = np.array([0 if i is None else i for i in ids], dtype="<i8").tobytes()
        absent = np.packbits([i is None for i in ids]).tobytes()
        bounds = np.append(starts, index.matrix.size).astype("<i8").tobytes()
        row = (TaskContext.get().partitionId() << 32 | number, present, absent, bounds, index.to_bytes())
        return pd.DataFrame([row], columns=[c.split()[0] for c in SHARDS.split(", ")])

    def shards(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids: list = []
        held: list[list[bytes]] = []
        size = number = 0
        for frame in frames:
            for i, text in zip(frame["doc_id"], frame["body"]):
                found = words(text)
                if held and size + len(found) + 1 > shard:
                    yield pack(ids, held, number)
                    ids, held, size, number = [], [], 0, number + 1
                ids.append(None if pd.isna(i) else int(i))
                held.append(found)
                size += len(found) + 1
        if held:
            yield pack(ids, held, number)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("body"))
    rows.mapInPandas(shards, SHARDS).write.parquet(path)


def windows(item: str | None, window: int = WINDOW) -> list[tuple[bytes, ...]]:
    found = words(item)
    if not found:
        return []
    return [tuple(found[i : i + window]) for i in range(max(1, len(found) - window + 1))]


def window_blocks(
    benchmark: DataFrame, id_col: str, text_col: str, window: int, block: int
) -> Iterator[dict[int, tuple[np.ndarray, list[list[str | None]]]]]:
    """Blocks of distinct windows with the items they occur in, by number of words."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(b" ".join(w), None if pd.isna(i) else str(i)) for i, t in zip(frame["item_id"], frame["body"]) for w in set(windows(t, window))]
            yield pd.DataFrame(rows, columns=["phrase", "item"])

    items = benchmark.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).alias("body"))
    spark, path = benchmark.sparkSession, fresh_path(benchmark.sparkSession, "windows")
    phrases = items.mapInPandas(cut, "phrase binary, item string").groupBy("phrase").agg(
        F.collect_set("item").alias("items"), F.max(F.col("item").isNull()).alias("nameless")
    )
    phrases = phrases.select("phrase", F.when(F.col("nameless"), F.array_append("items", F.lit(None))).otherwise(F.col("items")).alias("items"))
    phrases.write.parquet(path)
    stored = spark.read.parquet(path)
    count = max(1, -(-stored.count() // block))
    part = F.pmod(F.xxhash64("phrase"), F.lit(count))
    for b in range(count):
        made: dict[int, tuple[list, list]] = {}
        for row in stored.filter(part == b).toLocalIterator():
            phrase = bytes(row["phrase"]).split()
            texts, ids = made.setdefault(len(phrase), ([], []))
            texts.append(phrase)
            ids.append(row["items"])
        yield {n: (np.array(texts, dtype=object), ids) for n, (texts, ids) in made.items()}


def merge(firsts: np.ndarray, stops: np.ndarray) -> list[tuple[int, int]]:
    """The union of spans, as disjoint spans in order."""
    order = np.argsort(firsts, kind="stable")
    firsts, stops = firsts[order], np.maximum.accumulate(stops[order])
    begins = np.append(True, firsts[1:] > stops[:-1])
    last = np.append(np.flatnonzero(begins)[1:] - 1, len(firsts) - 1)
    return list(zip(firsts[begins].tolist(), stops[last].tolist()))


def search(spark: SparkSession, path: str, block: dict[int, tuple[np.ndarray, list[list[str | None]]]]) -> DataFrame:
    """Per document with hits: shard, ordinal, merged word spans, and the items hit."""
    sent = spark.sparkContext.broadcast(block)

    def hits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                index = FMIndex.from_bytes(row.index)
                starts = np.frombuffer(row.starts, dtype="<i8")
                found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
                items: list[list[str | None]] = []
                for size, (texts, ids) in sent.value.items():
                    number = index.number.get
                    patterns = np.array([[number(w, 0) for w in t] for t in texts], dtype=np.int64).reshape(len(texts), size)
                    low, high = index.ranges(patterns)
                    many = high - low
                    which = np.repeat(np.arange(len(texts)), many)
                    rows = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
                    at = index.places(rows)
                    found.append((at, at + size, which + len(items)))
                    items += ids
                at, stop, which = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, dtype=np.int64),) * 3
                if not len(at):
                    continue
                doc = np.searchsorted(starts, at, side="right") - 1
                order = np.argsort(doc, kind="stable")
                edges = np.flatnonzero(np.append(True, np.diff(doc[order]) != 0))
                out = []
                for group in np.split(order, edges[1:]):
                    d = int(doc[group[0]])
                    spans = merge(at[group] - starts[d], stop[group] - starts[d])
                    names = sorted({i for w in np.unique(which[group]) for i in items[w]}, key=lambda i: (i is None, i))
                    out.append((row.shard, d, [{"first": a, "stop": b} for a, b in spans], names))
                yield pd.DataFrame(out, columns=["shard", "ordinal", "spans", "items"])

    return spark.read.parquet(path).select("shard", "starts", "index").mapInPandas(hits, HITS)


def _documents(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for row in frame.itertuples():
            starts = np.frombuffer(row.starts, dtype="<i8")
            sizes = np.diff(starts) - 1
            absent = np.unpackbits(np.frombuffer(row.absent, dtype=np.uint8), count=len(sizes)) == 1
            ids = pd.Series(np.frombuffer(row.doc_ids, dtype="<i8")).astype("Int64").mask(absent)
            yield pd.DataFrame({"shard": row.shard, "ordinal": np.arange(len(sizes)), "doc_id": ids, "n_words": sizes})


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, block: int = BLOCK, shard: int = SHARD,
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, spans (disjoint, in words), items, contaminated."""
    spark = docs.sparkSession
    path, where = fresh_path(spark, "index"), fresh_path(spark, "hits")
    write_index(docs, path, id_col, text_col, shard)
    for part in window_blocks(benchmark, item_col, item_text_col, window, block):
        search(spark, path, part).write.mode("append").parquet(where)
    hits = spark.read.schema(HITS).parquet(where).groupBy("shard", "ordinal").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    hits = hits.withColumn("spans", _union(F.col("spans")))
    every = spark.read.parquet(path).select("shard", "doc_ids", "absent", "starts").mapInPandas(
        _documents, "shard long, ordinal long, doc_id long, n_words long"
    )
    n_hit = F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["first"]), F.lit(0)).cast("long")
    rows = every.join(hits, ["shard", "ordinal"], "left").withColumn("n_hit", n_hit)
    return rows.select(
        "doc_id", "n_words", "n_hit", "spans", F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * SHARE >= F.col("n_words"))).alias("contaminated"),
    )


def _union(spans: Column) -> Column:
    """Disjoint spans from ones in order, which overlap only where blocks met."""
    def step(acc: Column, s: Column) -> Column:
        meets = (F.size(acc) > 0) & (s["first"] <= F.try_element_at(acc, F.lit(-1))["stop"])
        tail = F.try_element_at(acc, F.lit(-1))
        longer = F.array(F.struct(tail["first"].alias("first"), F.greatest(tail["stop"], s["stop"]).alias("stop")))
        return F.when(meets, F.concat(F.slice(acc, 1, F.size(acc) - 1), longer)).otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(spans, F.array().cast("array<struct<first:bigint,stop:bigint>>"), step)


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of these spans and what stands between them."""
    places = [m.span() for m in WORD.finditer(text.translate(SMALL))]
    out, at = [], 0
    for first, stop in spans:
        out.append(text[at : places[first][0]])
        at = places[stop - 1][1]
    return "".join([*out, text[at:]])


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that are not contaminated, with their own columns.

    Every row is judged by its own text, whatever its id: what is searched, and what goes,
    is named by a hash of the text.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    held = docs.select(F.struct("*").alias("doc"), F.xxhash64(text).alias("named"))
    found = contamination(docs.select(F.xxhash64(text).alias("named"), text.alias("body")), benchmark, "named", "body")
    gone = found.filter("contaminated").select(F.col("doc_id").alias("named")).distinct()
    return held.join(gone, "named", "left_anti").select("doc.*")
