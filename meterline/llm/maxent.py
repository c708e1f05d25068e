"""Log-probabilities of documents: a unigram model and a hashed maximum-entropy model.

Tasks cut documents into blocks of about ``BLOCK`` tokens and number the words of a block,
so a text is tokenized once and every word crosses the network once per block. The counts
of all training tokens meet by word and go back to the blocks that hold the word; no
vocabulary is broadcast, and what is gathered grows with the corpus.

The model factors a word's probability: its class given the context, its slot in the class
given class and context, and the word's share of the slot. Class and slot are bits of a
hash of the word, so no table of words is needed, and the last factor is a smoothed count,
so the probabilities of all known words and one unknown word per slot add up to one. Both
softmaxes are linear in hashed features of the context: the word before, the two words
before, and the word two places back (a skip). Their biases start at the log frequencies.

Training goes once over all training tokens in ``ROUNDS`` rounds, each over its share of
the blocks. A task starts at the current weights, takes one adaptive gradient step per
mini-batch, and sends the change; changes are averaged by tokens, first in groups and then
over all. The weights have a fixed size whatever the corpus.

Defined cases: a null or empty text is its end token alone; a null id is learned from; rows
that repeat an id each give a row; without training rows a token's base probability is 1;
an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterline.llm.simhash import LOWER
from meterline.scratch import fresh_path

BLOCK = 1 << 21
CLASSES = 32
SLOTS = 32
ROWS = 1 << 13
FEATURES = 3
BATCH = 1 << 13
ROUNDS = 4
RATE = 0.2
OFTEN = 12
PARTS = 16
GROUPS = 64
END_WORD = b" "

BLOCKS = "block long, doc_ids binary, absent binary, train binary, sizes binary, codes binary, words binary"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
# Odd multipliers that spread hashes.
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)
SHIFT = np.uint64(64 - (ROWS.bit_length() - 1))


class Numbers(dict):
    """Numbers words in the order they are first asked for, the end of a text first."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def _blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of BLOCKS: documents as codes of the block's own words; 0 ends each document."""
    press = zstandard.ZstdCompressor(level=1).compress
    number, held = 0, 0
    ids: list[int | None] = []
    codes: list[np.ndarray] = []
    words = Numbers({END_WORD: 0})

    def pack() -> pd.DataFrame:
        row = (
            TaskContext.get().partitionId() << 32 | number,
            np.array([0 if i is None else i for i in ids], dtype="<i8").tobytes(),
            np.packbits([i is None for i in ids]).tobytes(),
            np.packbits([not held_out(i) for i in ids]).tobytes(),
            np.array([len(c) for c in codes], dtype="<u4").tobytes(),
            press(np.concatenate(codes).tobytes()),
            press(b" ".join(list(words)[1:])),
        )
        return pd.DataFrame([row], columns=[c.split()[0] for c in BLOCKS.split(", ")])

    for frame in frames:
        for i, text in zip(frame["doc_id"], frame["body"]):
            found = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
            found.append(END_WORD)
            codes.append(np.fromiter(map(words.__getitem__, found), dtype="<u4", count=len(found)))
            ids.append(None if pd.isna(i) else int(i))
            held += len(found)
            if held >= BLOCK:
                yield pack()
                number, held, ids, codes, words = number + 1, 0, [], [], Numbers({END_WORD: 0})
    if ids:
        yield pack()


class Block:
    """A row of BLOCKS in memory."""

    def __init__(self, row):
        loose = zstandard.ZstdDecompressor().decompress
        self.sizes = np.frombuffer(row.sizes, dtype="<u4").astype(np.int64)
        self.codes = np.frombuffer(loose(row.codes), dtype="<u4").astype(np.int64)
        self.words = [END_WORD, *loose(row.words).split()]
        bits = lambda raw: np.unpackbits(np.frombuffer(raw, dtype=np.uint8), count=len(self.sizes)) == 1
        self.train, self.absent = bits(row.train), bits(row.absent)
        self.doc_ids = np.frombuffer(row.doc_ids, dtype="<i8")
        self.ends = np.cumsum(self.sizes)

    def learned(self) -> np.ndarray:
        """Per token, whether its document is learned from."""
        return np.repeat(self.train, self.sizes)

    def hashes(self) -> np.ndarray:
        return np.fromiter(map(zlib.crc32, self.words), dtype=np.uint64, count=len(self.words))

    def context(self) -> tuple[np.ndarray, np.ndarray]:
        """Per token: the hash of its word, and its feature rows, one column a feature."""
        own = self.hashes()[self.codes]
        starts = self.ends - self.sizes
        one = np.concatenate(([np.uint64(0)], own[:-1]))
        two = np.concatenate((np.zeros(2, dtype=np.uint64), own[:-2]))[: len(own)]
        one[starts] = two[starts] = np.uint64(1)
        longer = starts[self.sizes > 1] + 1
        two[longer] = np.uint64(1)
        rows = np.stack([one * MIX[0], (one * MIX[1] + two) * MIX[2], two * MIX[3] + MIX[0]], axis=1)
        return own, rows


def classes_of(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class and slot of words by hash."""
    plain = hashes.astype(np.int64)
    return plain % CLASSES, plain // CLASSES % SLOTS


class Weights:
    """Feature weights of both softmaxes, and biases."""

    def __init__(self, by_class: np.ndarray, by_slot: np.ndarray, class_bias: np.ndarray, slot_bias: np.ndarray):
        self.by_class, self.by_slot, self.class_bias, self.slot_bias = by_class, by_slot, class_bias, slot_bias

    def rows(self, mixed: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The weight rows of features, for the classes and for the slots of the true class."""
        first = (mixed * MIX[2] >> SHIFT).astype(np.int64)
        second = ((mixed + classes.astype(np.uint64)[:, None] * MIX[1]) * MIX[0] >> SHIFT).astype(np.int64)
        return first, second

    @staticmethod
    def _softmax(table: np.ndarray, rows: np.ndarray, bias: np.ndarray) -> np.ndarray:
        logits = bias + table.take(rows[:, 0], axis=0)
        for k in range(1, rows.shape[1]):
            logits += table.take(rows[:, k], axis=0)
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def probabilities(self, mixed: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distributions over classes and over slots, with the rows they came from."""
        first, second = self.rows(mixed, classes)
        return (
            self._softmax(self.by_class, first, self.class_bias),
            self._softmax(self.by_slot, second, self.slot_bias[classes]), first, second,
        )


def _sums(rows: np.ndarray, slope: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows that occur, and the sum of the slopes of each.

    The first slope of every row, then the second of those that have one, and so on: few
    steps, as few rows occur often; those that do are added up by themselves.
    """
    order = np.argsort(rows, kind="stable")
    ordered = rows.take(order)
    new = np.ones(len(rows), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(rows)))
    total = slope.take(order.take(starts), axis=0)
    for g in np.flatnonzero(sizes > OFTEN).tolist():
        total[g] = slope.take(order[starts[g] : starts[g] + sizes[g]], axis=0).sum(axis=0)
    turn, more = 1, np.flatnonzero((sizes > 1) & (sizes <= OFTEN))
    while len(more):
        total[more] += slope.take(order.take(starts.take(more) + turn), axis=0)
        turn += 1
        more = more[sizes.take(more) > turn]
    return ordered.take(starts).astype(np.int64), total


def _step(table: np.ndarray, squares: np.ndarray, rows: np.ndarray, slope: np.ndarray) -> None:
    """One adaptive gradient step: slopes summed by weight row, scaled by what the row has seen."""
    for k in range(rows.shape[1]):
        at, total = _sums(rows[:, k].astype(np.uint16), slope)  # short numbers are sorted by digits
        squares[at] += np.square(total).mean(axis=1)
        total *= (RATE / np.sqrt(squares.take(at) + 1.0))[:, None]
        table[at] += total


def learn(block: Block, weights: Weights, squares: tuple[np.ndarray, np.ndarray]) -> int:
    """Steps over the training tokens of a block, in place; how many there were."""
    use = block.learned()
    own, mixed = block.context()
    own, mixed = own[use], mixed[use]
    classes, slots = classes_of(own)
    for at in range(0, len(own), BATCH):
        c, s = classes[at : at + BATCH], slots[at : at + BATCH]
        over_classes, over_slots, first, second = weights.probabilities(mixed[at : at + BATCH], c)
        line = np.arange(len(c))
        for table, square, rows, found, true in (
            (weights.by_class, squares[0], first, over_classes, c), (weights.by_slot, squares[1], second, over_slots, s),
        ):
            slope = -found
            slope[line, true] += 1
            _step(table, square, rows, slope)
    return len(own)


def log10_probabilities(block: Block, weights: Weights) -> np.ndarray:
    """Per token, of its class and slot."""
    own, mixed = block.context()
    classes, slots = classes_of(own)
    out = np.empty(len(own))
    for at in range(0, len(own), BATCH):
        c, s = classes[at : at + BATCH], slots[at : at + BATCH]
        over_classes, over_slots, _, _ = weights.probabilities(mixed[at : at + BATCH], c)
        line = np.arange(len(c))
        found = over_classes[line, c].astype(np.float64) * over_slots[line, s]
        out[at : at + BATCH] = np.log10(np.maximum(found, 1e-30))
    return out


def write_blocks(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("body"))
    rows.mapInPandas(_blocks, BLOCKS).write.parquet(path)


def _vocabulary(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for row in frame.itertuples():
            block = Block(row)
            n = np.bincount(block.codes[block.learned()], minlength=len(block.words))
            yield pd.DataFrame({"word": block.words, "block": row.block, "code": np.arange(len(n)), "n": n})


def word_counts(blocks: DataFrame) -> DataFrame:
    """(block, code, c, first, bucket): training counts of each block's words.

    ``first`` marks one row per word. A word has at most one row per block, so the largest
    group is as large as the number of blocks.
    """
    rows = blocks.mapInPandas(_vocabulary, "word binary, block long, code int, n long")
    word = Window.partitionBy("word")
    bucket = (F.crc32("word") % (CLASSES * SLOTS)).cast("int")
    return rows.select(
        "block", "code", F.sum("n").over(word).alias("c"), (F.min("block").over(word) == F.col("block")).alias("first"), bucket.alias("bucket")
    )


def train(blocks: DataFrame, start: Weights, rounds: int = ROUNDS) -> Weights:
    """Weights after one pass over all training tokens, in rounds over parts of the blocks."""
    spark = blocks.sparkSession
    now = start
    shape = now.by_class.shape, now.by_slot.shape
    cut = now.by_class.size
    for r in range(rounds):
        sent = spark.sparkContext.broadcast(now)

        def changes(frames: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            base = sent.value
            own = Weights(base.by_class.copy(), base.by_slot.copy(), base.class_bias, base.slot_bias)
            squares = np.zeros(ROWS, dtype=np.float32), np.zeros(ROWS, dtype=np.float32)
            seen = 0
            for frame in frames:
                for row in frame.itertuples():
                    seen += learn(Block(row), own, squares)
            if seen:
                delta = np.concatenate(((own.by_class - base.by_class).ravel(), (own.by_slot - base.by_slot).ravel()))
                group = TaskContext.get().partitionId() % GROUPS
                rows = [(i, group, seen, p.astype(np.float16).tobytes()) for i, p in enumerate(np.split(delta, PARTS))]
                yield pd.DataFrame(rows, columns=["part", "grp", "seen", "delta"])

        def mean(rows: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(d, dtype=np.float16).astype(np.float32) * n for d, n in zip(rows["delta"], rows["seen"]))
            seen = int(rows["seen"].sum())
            return pd.DataFrame(
                [(rows["part"].iloc[0], rows["grp"].iloc[0], seen, (total / seen).astype(np.float16).tobytes())], columns=["part", "grp", "seen", "delta"]
            )

        kind = "part int, grp int, seen long, delta binary"
        share = blocks.filter(F.pmod(F.xxhash64("block"), F.lit(rounds)) == r)
        grouped = share.mapInPandas(changes, kind).groupBy("part", "grp").applyInPandas(mean, kind)
        parts = grouped.groupBy("part").applyInPandas(mean, kind).collect()
        if parts:
            delta = np.concatenate([np.frombuffer(p["delta"], dtype=np.float16) for p in sorted(parts, key=lambda p: p["part"])]).astype(np.float32)
            now = Weights(now.by_class + delta[:cut].reshape(shape[0]), now.by_slot + delta[cut:].reshape(shape[1]), now.class_bias, now.slot_bias)
        sent.unpersist()
    return now


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Per document: SCORES; learned from the documents that are not held out."""
    spark = docs.sparkSession
    path, where = fresh_path(spark, "blocks"), fresh_path(spark, "counts")
    write_blocks(docs, path, id_col, text_col)
    blocks = spark.read.parquet(path)
    word_counts(blocks).write.parquet(where)
    counts = spark.read.parquet(where)
    # One row per class and slot.
    known = counts.filter("first AND c > 0").groupBy("bucket").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    mass, kinds = np.zeros(CLASSES * SLOTS), np.zeros(CLASSES * SLOTS)
    for row in known:
        mass[row["bucket"]], kinds[row["bucket"]] = row["n"], row["v"]
    total, distinct = int(mass.sum()), int(kinds.sum())
    weight = (mass + 0.5 * (kinds + 1)).reshape(SLOTS, CLASSES).T
    zeros = lambda n: np.zeros((ROWS, n), dtype=np.float32)
    class_bias = np.log(weight.sum(axis=1) / weight.sum()).astype(np.float32)
    slot_bias = np.log(weight / weight.sum(axis=1, keepdims=True)).astype(np.float32)
    weights = train(blocks, Weights(zeros(CLASSES), zeros(SLOTS), class_bias, slot_bias), rounds)
    sent = spark.sparkContext.broadcast((weights, mass, kinds))

    def scored(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        model, mass, kinds = sent.value
        out = []
        for row in left.itertuples():
            block = Block(row)
            by_code = np.zeros(len(block.words))
            by_code[right["code"].to_numpy()] = right["c"].to_numpy()
            base = np.log10((by_code + 0.5) / (total + 0.5 * (distinct + 1)))[block.codes]
            bucket = (block.hashes() % np.uint64(CLASSES * SLOTS)).astype(np.int64)
            share = np.log10((by_code + 0.5) / (mass + 0.5 * (kinds + 1))[bucket])[block.codes]
            tokens = share + log10_probabilities(block, model)
            starts = block.ends - block.sizes
            out.append(
                pd.DataFrame(
                    {
                        "doc_id": pd.Series(block.doc_ids).astype("Int64").mask(block.absent),
                        "held_out": ~block.train,
                        "n_tokens": block.sizes,
                        "n_known": np.add.reduceat((by_code > 0).astype(np.int64)[block.codes], starts),
                        "train_tokens": total,
                        "base_score": np.add.reduceat(base, starts),
                        "score": np.add.reduceat(tokens, starts),
                    }
                )
            )
        return pd.concat(out) if out else pd.DataFrame(columns=[c.split()[0] for c in SCORES.split(", ")])

    slim = counts.select("block", "code", "c")
    return blocks.groupBy("block").cogroup(slim.groupBy("block")).applyInPandas(scored, SCORES)
