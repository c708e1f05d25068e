"""Token ids of documents in files that answer lookups: one wavelet matrix per shard.

Documents are range-partitioned by id, so shards follow each other in id order. A task
encodes its documents in that order and closes a shard whenever it holds ``SHARD`` ids; a
document is never cut. A shard is one row of a Parquet table in a task's own file: the
documents' ids and lengths and the compressed matrix, from which any token can be read,
counted or located without the rest.

Texts are encoded with the tokenizers library. The pre-tokenizer of a byte-level
vocabulary never joins a blank that has a visible character behind it to what stands
before, so a text may be cut there without changing its ids: the cuts that recur in a task
are encoded once and remembered, up to ``MEMO`` of them. A text with any other blank is
encoded whole.

Defined cases: a null or empty text has the end id alone; rows that repeat an id follow
each other in order of a hash of their texts; a null id comes first; an empty table gives
no shard and no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from meterline.llm.wavelet import WaveletMatrix
from meterline.scratch import fresh_path

VOCABULARY = "byte_bpe_50k.json"
END = 0
SHARD = 1 << 21
MEMO = 1_000_000
CHARACTERS = 1 << 21  # of text encoded at a time
TOGETHER = 128
BLANK = "\u0120"  # how a byte-level vocabulary spells a blank
SPECIAL = "<|"  # texts that might spell a special token are encoded whole
LOOSE_BLANK = re.compile(r" (?:\s|\Z)")

SHARDS = "shard long, doc_ids binary, absent binary, sizes binary, matrix binary"
ROWS = "shard long, ordinal long, doc_id long, n_tokens long, ids_crc32 long"


class Memo(dict):
    """Numbers pieces in the order they are first asked for."""

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        return number


class Encoder:
    """Whole texts to ids, remembering what a piece after a blank encodes to.

    Pieces that are new are encoded together, each behind its blank; a byte-level token
    that begins with a blank begins a piece, so the ids fall apart again by that.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        tokens = self.tokenizer.get_vocab()
        self.blank_led = np.zeros(max(tokens.values()) + 1, dtype=bool)
        self.blank_led[[i for t, i in tokens.items() if t.startswith(BLANK)]] = True
        self.clear()

    def clear(self) -> None:
        self.known = Memo()
        self.ids = np.zeros(0, dtype=np.uint32)
        self.starts = np.zeros(0, dtype=np.int64)
        self.sizes = np.zeros(0, dtype=np.int64)

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and their number by text."""
        got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, got), dtype=np.int64, count=len(got))
        return np.fromiter(chain.from_iterable(got), dtype=np.uint32, count=int(sizes.sum())), sizes

    def _learn(self, pieces: list[str]) -> None:
        joined = [" " + " ".join(pieces[i : i + TOGETHER]) for i in range(0, len(pieces), TOGETHER)]
        flat, _ = self._encoded(joined)
        starts = np.flatnonzero(self.blank_led[flat])
        if len(starts) == len(pieces):
            sizes = np.diff(np.append(starts, len(flat)))
        else:  # a vocabulary whose tokens do not keep pieces apart
            flat, sizes = self._encoded([" " + p for p in pieces])
            starts = np.cumsum(sizes) - sizes
        self.starts = np.concatenate((self.starts, len(self.ids) + starts))
        self.ids = np.concatenate((self.ids, flat))
        self.sizes = np.concatenate((self.sizes, sizes))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text, in order."""
        out: list[np.ndarray] = [np.zeros(0, dtype=np.uint32)] * len(texts)
        alone = {i: t for i, t in enumerate(texts) if LOOSE_BLANK.search(t) or SPECIAL in t}
        cut = [i for i, t in enumerate(texts) if t and i not in alone]
        for i, text in alone.items():
            out[i] = self._encoded([text])[0]
        if not cut:
            return out
        if len(self.known) > MEMO:
            self.clear()
        # Arrow numbers the words of the batch, so each of them is looked up once.
        split = pc.split_pattern(pa.array([texts[i] for i in cut], pa.large_string()), " ")
        firsts = np.asarray(split.offsets)[:-1]
        coded = split.flatten().dictionary_encode()
        codes, words = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        counts = np.diff(np.append(firsts, len(codes))) - 1
        heads = [words[c] for c in codes[firsts].tolist()]
        behind = np.ones(len(codes), dtype=bool)
        behind[firsts] = False
        tails = codes[behind]
        seen = np.flatnonzero(np.bincount(tails, minlength=len(words)))
        before = len(self.known)
        numbers = np.zeros(len(words), dtype=np.int64)
        numbers[seen] = np.fromiter(map(self.known.__getitem__, map(words.__getitem__, seen.tolist())), dtype=np.int64, count=len(seen))
        if len(self.known) > before:
            self._learn(list(islice(self.known, before, None)))
        which = numbers[tails]
        sizes = self.sizes[which]
        ends = np.cumsum(sizes)
        take = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[which] - (ends - sizes), sizes)
        tail_ids = self.ids[take]
        head_ids, head_sizes = self._encoded(heads)
        stops = np.append(0, ends)[np.cumsum(counts)]
        head_stops = np.cumsum(head_sizes)
        at = head_at = 0
        for i, stop, head_stop in zip(cut, stops.tolist(), head_stops.tolist()):
            out[i] = np.concatenate((head_ids[head_at:head_stop], tail_ids[at:stop]))
            at, head_at = stop, head_stop
        return out


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, shard: int = SHARD) -> None:
    """Encode the documents in id order and write their shards below path."""
    named = vocabulary

    def pack(ids: list[int | None], parts: list[np.ndarray], number: int) -> pd.DataFrame:
        sizes = np.array([len(p) for p in parts], dtype="<u4")
        present = np.array([0 if i is None else i for i in ids], dtype="<i8")
        absent = np.packbits([i is None for i in ids])
        matrix = WaveletMatrix.of(np.concatenate(parts)).to_bytes()
        row = (TaskContext.get().partitionId() << 32 | number, present.tobytes(), absent.tobytes(), sizes.tobytes(), matrix)
        return pd.DataFrame([row], columns=[c.split()[0] for c in SHARDS.split(", ")])

    def shards(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool = encoder(named or public_tokenizers.path(VOCABULARY))
        end = np.array([END], dtype=np.uint32)
        ids: list = []
        parts: list[np.ndarray] = []
        held = number = 0
        for frame in frames:
            runs = frame["body"].str.len().cumsum() // CHARACTERS
            for _, some in frame.groupby(runs, sort=True):
                for i, found in zip(some["doc_id"], tool.encode(some["body"].tolist())):
                    ids.append(None if pd.isna(i) else int(i))
                    parts.append(np.concatenate((found, end)))
                    held += len(found) + 1
                    if held >= shard:
                        yield pack(ids, parts, number)
                        ids, parts, held, number = [], [], 0, number + 1
        if ids:
            yield pack(ids, parts, number)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    # Rows that repeat an id, or have none, spread by their texts.
    turn = F.xxhash64("body")
    ordered = rows.repartitionByRange("doc_id", turn).sortWithinPartitions("doc_id", turn)
    ordered.mapInPandas(shards, SHARDS).write.parquet(path)


def _documents(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for row in frame.itertuples():
            sizes = np.frombuffer(row.sizes, dtype="<u4").astype(np.int64)
            flat = WaveletMatrix.from_bytes(row.matrix).symbols().astype("<u4")
            ends = np.cumsum(sizes)
            sums = [zlib.crc32(flat[e - n : e].tobytes()) for e, n in zip(ends.tolist(), sizes.tolist())]
            ids = pd.Series(np.frombuffer(row.doc_ids, dtype="<i8")).astype("Int64")
            absent = np.unpackbits(np.frombuffer(row.absent, dtype=np.uint8), count=len(sizes)) == 1
            yield pd.DataFrame(
                {"shard": row.shard, "ordinal": np.arange(len(sizes)), "doc_id": ids.mask(absent), "n_tokens": sizes, "ids_crc32": sums}
            )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document as read back: doc_id, start, n_tokens, ids_crc32."""
    where = fresh_path(spark, "tokens")
    spark.read.parquet(path).mapInPandas(_documents, ROWS).write.parquet(where)
    rows = spark.read.parquet(where)
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = rows.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    bases = shards.select("shard", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return placed.join(bases, "shard").select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def lookup(spark: SparkSession, path: str, token: int) -> DataFrame:
    """Per shard that has it: how often a token occurs and where, from the matrix alone."""

    def places(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                matrix = WaveletMatrix.from_bytes(row.matrix)
                count = int(matrix.count(np.array([token]))[0])
                if count:
                    yield pd.DataFrame([(row.shard, count, matrix.occurrences(token).tolist())], columns=["shard", "n", "places"])

    return spark.read.parquet(path).select("shard", "matrix").mapInPandas(places, "shard long, n long, places array<long>")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Write the documents to fresh files in the shared folder and read them back."""
    spark = docs.sparkSession
    path = fresh_path(spark, "shards")
    write_shards(docs, path, id_col, text_col, vocabulary)
    return read_documents(spark, path)
