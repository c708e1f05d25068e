"""Tokens of two tokenizers aligned: groups between shared cuts, and how often ids meet in them.

Both tokenizers see the same bytes, a blank and the text. A cut is a byte offset at which a
token of either ends. Cuts are found by divide and conquer: of an interval of tokens that
begins and ends with a cut, the end of the middle token of one tokenizer is looked up among
the ends of the other by bisection; if it is not there, the next ends around the middle are
tried; at the first common end the interval falls apart into two of the same kind. An
interval without a common end is a group. All open intervals of a batch of documents take
each step together, as arrays.

Two ids are linked wherever a token of either stands in the same group. Documents go into
blocks that name every pair of ids once, with the number of their documents that hold it
linked; the counts of all blocks meet by pair, and go back to the blocks, where every document
keeps its pairs as short numbers. So no table of all pairs is sent to anyone, and a text is
encoded once.

A piece of text between blanks is encoded once and remembered, up to ``MEMO`` of them: neither
tokenizer joins a blank in front of a visible character to what stands before. Texts with other
blanks, and all texts if a vocabulary does join them, are encoded whole.

Defined cases: a null or empty text has no tokens, nor has one that a tokenizer does not give
back byte by byte; rows that repeat an id count as documents of their own; an empty table gives
an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from meterline.llm.token_files import BLANK, LOOSE_BLANK, Memo
from meterline.scratch import fresh_path

BYTE_VOCABULARY = "byte_bpe_50k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"
LED = "▁"  # how a vocabulary of pieces spells a blank
MEMO = 600_000
TOGETHER = 128
CHARACTERS = 1 << 20  # of text aligned at a time
BLOCK = 1 << 22  # links of a block

BEFORE, BEHIND = ("a", "1", ".", "'", "\t", "\n", "\0", "\xa0", "é", "字", "🙂"), ("a", "1", ".", "'s", "\0", "é", "字", "🙂")

NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]
BLOCKS = "block long, docs int, doc_ids binary, numbers binary, groups binary, entries binary, codes binary, times binary, pairs binary, holders binary"
ROWS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
SHIFT = 24  # bits of an id of the second vocabulary within a pair


def byte_letters() -> dict[str, int]:
    """Of a byte-level vocabulary, the byte of each letter: visible Latin-1 stands for itself, other bytes follow 255."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in own}
    letters.update({chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in set(own))})
    return letters


def _stretches(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all stretches, one behind the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class Vocabulary:
    """One tokenizer: ids of texts, the bytes of its tokens, and what pieces encode to."""

    def __init__(self, token_bytes: list[bytes], leads: list[bool], joins: bool):
        self.token_bytes = token_bytes
        self.lengths = np.array([len(b) for b in token_bytes], dtype=np.int64)
        self.leads = np.array(leads, dtype=bool)
        self.joins = joins  # whether a token may hold a blank behind something else
        self.clear()

    def clear(self) -> None:
        self.ids = np.zeros(0, dtype=np.int64)
        self.starts = np.zeros(0, dtype=np.int64)
        self.sizes = np.zeros(0, dtype=np.int64)
        self.exact = np.zeros(0, dtype=bool)

    def encode(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def spells(self, ids: list[int], text: str) -> bool:
        return b"".join(map(self.token_bytes.__getitem__, ids)) == b" " + text.encode("utf-8", "surrogatepass")

    def learn(self, pieces: list[str]) -> None:
        """Encode new pieces together; a token that begins with a blank begins a piece."""
        joined = [" ".join(pieces[i : i + TOGETHER]) for i in range(0, len(pieces), TOGETHER)]
        found = self.encode(joined)
        flat = np.fromiter(chain.from_iterable(found), dtype=np.int64)
        starts = np.flatnonzero(self.leads[flat]) if len(flat) else flat
        exact = np.zeros(len(pieces), dtype=bool)
        if len(starts) == len(pieces):
            sizes = np.diff(np.append(starts, len(flat)))
            # A text has as many blanks as pieces, so if it is spelled right each of them is.
            good = [self.spells(ids, t) for ids, t in zip(found, joined)]
            exact = np.repeat(good, TOGETHER)[: len(pieces)]
        else:  # a piece that spells a blank of the vocabulary itself
            found = self.encode(pieces)
            flat = np.fromiter(chain.from_iterable(found), dtype=np.int64)
            sizes = np.array([len(ids) for ids in found], dtype=np.int64)
            starts = np.cumsum(sizes) - sizes
        if not exact.all():
            plain = flat.tolist()
            for i in np.flatnonzero(~exact).tolist():
                exact[i] = self.spells(plain[starts[i] : starts[i] + sizes[i]], pieces[i])
        self.starts = np.concatenate((self.starts, len(self.ids) + starts))
        self.ids = np.concatenate((self.ids, flat))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.exact = np.concatenate((self.exact, exact))


class Bytes(Vocabulary):
    """A byte-level vocabulary; texts get a blank in front."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tool = Tokenizer.from_file(path)
        self.tool.encode_special_tokens = True
        letters, entries = byte_letters(), sorted((i, t) for t, i in self.tool.get_vocab().items())
        by_id = dict(entries)
        names = [by_id.get(i, "") for i in range(entries[-1][0] + 1)]
        spelled = [bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t in names]
        # Texts are split before tokens are formed: does a blank before something visible always begin a part?
        parts = [[p for p, _ in self.tool.pre_tokenizer.pre_tokenize_str(a + " " + b)] for a in BEFORE for b in BEHIND]
        joins = any(not any(p.startswith(BLANK) for p in found[1:]) for found in parts)
        super().__init__(spelled, [t.startswith(BLANK) for t in names], joins)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tool.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class Pieces(Vocabulary):
    """A vocabulary of pieces that puts a blank in front by itself."""

    def __init__(self, path: str):
        self.tool = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.tool.id_to_piece(i) for i in range(self.tool.get_piece_size())]
        spelled = [bytes([int(t[3:5], 16)]) if self.tool.is_byte(i) else t.replace(LED, " ").encode() for i, t in enumerate(names)]
        super().__init__(spelled, [t.startswith(LED) for t in names], any(LED in t.lstrip(LED) for t in names))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.tool.encode(texts, num_threads=1)


def shared_cuts(a_ends: np.ndarray, b_ends: np.ndarray, a_bounds: np.ndarray, b_bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a cut follows each token of a and of b.

    Ends grow over the whole batch; bounds are the numbers of tokens before each document and
    after the last, and every document has tokens of both.
    """
    a_cut, b_cut = np.zeros(len(a_ends), dtype=bool), np.zeros(len(b_ends), dtype=bool)
    a_cut[a_bounds[1:] - 1] = b_cut[b_bounds[1:] - 1] = True
    a_lo, a_hi, b_lo, b_hi = a_bounds[:-1], a_bounds[1:], b_bounds[:-1], b_bounds[1:]
    tried = np.zeros(len(a_lo), dtype=np.int64)
    while True:
        inner = a_hi - a_lo - 1  # ends that may be cuts
        active = np.flatnonzero((inner > tried) & (b_hi - b_lo > 1))
        if not len(active):
            return a_cut, b_cut
        a_lo, a_hi, b_lo, b_hi, tried, inner = (x[active] for x in (a_lo, a_hi, b_lo, b_hi, tried, inner))
        # From the middle to both sides: 0, +1, -1, +2, -2 and so on, in a ring.
        middle = (inner - 1) // 2
        away = np.where(tried & 1, (tried + 1) >> 1, -(tried >> 1))
        token = a_lo + (middle + away) % inner
        at = np.searchsorted(b_ends, a_ends[token])
        met = b_ends[at] == a_ends[token]
        token, at = token[met], at[met]
        a_cut[token] = b_cut[at] = True
        rest = ~met
        both = lambda left, right, stay: np.concatenate((left, right, stay))
        none = np.zeros(len(token), dtype=np.int64)
        a_lo, a_hi, b_lo, b_hi, tried = (
            both(a_lo[met], token + 1, a_lo[rest]), both(token + 1, a_hi[met], a_hi[rest]),
            both(b_lo[met], at + 1, b_lo[rest]), both(at + 1, b_hi[met], b_hi[rest]),
            both(none, none, tried[rest] + 1),
        )


class Aligned:
    """Documents that both tokenizers spell alike, aligned."""

    def __init__(self, a_ids: np.ndarray, b_ids: np.ndarray, a_counts: np.ndarray, b_counts: np.ndarray, a: Vocabulary, b: Vocabulary):
        self.a_ids, self.b_ids, self.n = a_ids, b_ids, len(a_counts)
        self.a_bounds, self.b_bounds = (np.concatenate(([0], np.cumsum(c))) for c in (a_counts, b_counts))
        a_cut, b_cut = shared_cuts(np.cumsum(a.lengths[a_ids]), np.cumsum(b.lengths[b_ids]), self.a_bounds, self.b_bounds)
        a_stops, b_stops = np.flatnonzero(a_cut) + 1, np.flatnonzero(b_cut) + 1
        self.a_sizes, self.b_sizes = np.diff(a_stops, prepend=0), np.diff(b_stops, prepend=0)
        self.a_cut, self.b_cut, self.a_stops, self.b_stops = a_cut, b_cut, a_stops, b_stops
        self.group_bounds = np.concatenate(([0], np.searchsorted(a_stops, self.a_bounds[1:], side="right")))

    def numbers(self) -> np.ndarray:
        """NUMBERS of each document, one row each."""
        links = np.concatenate(([0], np.cumsum(self.a_sizes * self.b_sizes)))[self.group_bounds]
        return np.stack([np.diff(x) for x in (self.a_bounds, self.b_bounds, self.group_bounds, links)], axis=1)

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, pair, times) of all linked pairs, by document and pair."""
        group = np.repeat(np.arange(len(self.a_sizes)), self.a_sizes)  # of each token of a
        each = self.b_sizes[group]
        pairs = np.repeat(self.a_ids, each) << SHIFT | self.b_ids[_stretches((self.b_stops - self.b_sizes)[group], each)]
        document = np.repeat(np.arange(self.n), self.numbers()[:, 3])
        kinds, short = np.unique(pairs, return_inverse=True)
        both = np.sort(document * len(kinds) + short)
        first = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1]))) if len(both) else both
        times = np.diff(np.append(first, len(both)))
        return both[first] // max(1, len(kinds)), kinds[both[first] % max(1, len(kinds))], times

    def texts(self, table: list[str], a_kinds: int) -> list[str]:
        """The groups of each document; table has, for each id, its text inside and at the end of its side."""
        n_a, n_b = len(self.a_ids), len(self.b_ids)
        order = np.empty(n_a + n_b, dtype=np.int64)
        b_before = np.repeat(self.b_stops - self.b_sizes, self.a_sizes)
        a_upto = np.repeat(self.a_stops, self.b_sizes)
        order[np.arange(n_a) + b_before] = self.a_ids * 2 + self.a_cut
        order[np.arange(n_b) + a_upto] = (self.b_ids + a_kinds) * 2 + self.b_cut
        spelled = list(map(table.__getitem__, order.tolist()))
        bounds = (self.a_bounds + self.b_bounds).tolist()
        return ["".join(spelled[s:e])[:-1] for s, e in zip(bounds, bounds[1:])]


class Aligner:
    """Both tokenizers with their memory of pieces."""

    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.b = Bytes(byte_path), Pieces(piece_path)
        self.whole = self.a.joins or self.b.joins
        self.known = Memo()
        a_kinds = len(self.a.token_bytes)
        self.table = [x for i in range(a_kinds) for x in (f"{i},", f"{i}|")] + [x for i in range(len(self.b.token_bytes)) for x in (f"{i},", f"{i};")]
        if len(self.b.token_bytes) > 1 << SHIFT:
            raise ValueError("too many ids")

    def align(self, texts: list[str]) -> list[tuple[list[int], Aligned]]:
        """Aligned documents with their places; texts without tokens are in none."""
        cut = [i for i, t in enumerate(texts) if t and not self.whole and not LOOSE_BLANK.search(" " + t)]
        rest = [i for i, t in enumerate(texts) if t and (self.whole or LOOSE_BLANK.search(" " + t))]
        out = []
        if cut:
            if len(self.known) > MEMO:
                self.known = Memo()
                self.a.clear()
                self.b.clear()
            split = [texts[i].split(" ") for i in cut]
            counts = np.array([len(s) for s in split], dtype=np.int64)
            before = len(self.known)
            which = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), dtype=np.int64, count=int(counts.sum()))
            if len(self.known) > before:
                new = list(islice(self.known, before, None))
                self.a.learn(new)
                self.b.learn(new)
            starts = np.cumsum(counts) - counts
            exact = np.logical_and.reduceat(self.a.exact[which] & self.b.exact[which], starts)
            rest += [i for i, good in zip(cut, exact.tolist()) if not good]
            which = which[np.repeat(exact, counts)]
            if len(which):
                counts = counts[exact]
                starts = np.cumsum(counts) - counts
                sides = []
                for v in (self.a, self.b):
                    sizes = v.sizes[which]
                    sides.append((v.ids[_stretches(v.starts[which], sizes)], np.add.reduceat(sizes, starts)))
                (a_ids, a_counts), (b_ids, b_counts) = sides
                out.append(([i for i, good in zip(cut, exact.tolist()) if good], Aligned(a_ids, b_ids, a_counts, b_counts, self.a, self.b)))
        if rest:
            of = [texts[i] for i in rest]
            found = [(i, x, y) for i, t, x, y in zip(rest, of, self.a.encode(of), self.b.encode(of)) if self.a.spells(x, t) and self.b.spells(y, t)]
            if found:
                flat = [np.array([i for f in found for i in f[k]], dtype=np.int64) for k in (1, 2)]
                sizes = [np.array([len(f[k]) for f in found], dtype=np.int64) for k in (1, 2)]
                out.append(([f[0] for f in found], Aligned(*flat, *sizes, self.a, self.b)))
        return out


@lru_cache(maxsize=1)
def aligner(byte_path: str, piece_path: str) -> Aligner:
    return Aligner(byte_path, piece_path)


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers below 2^32, byte by byte, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


class Block:
    """Documents of one task, until there are enough."""

    def __init__(self):
        self.ids: list[int | None] = []
        self.numbers: list[np.ndarray] = []
        self.groups: list[str] = []
        self.sizes: list[np.ndarray] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.links = 0

    def add(self, ids: list[int | None], texts: list[str], tool: Aligner, digest: bool) -> None:
        n = len(ids)
        numbers, groups = np.zeros((n, 4), dtype=np.int64), [""] * n
        documents, pairs, times = [], [], []
        for places, aligned in tool.align(texts):
            own = np.array(places)
            numbers[own] = aligned.numbers()
            for i, text in zip(places, aligned.texts(tool.table, len(tool.a.token_bytes))):
                groups[i] = hashlib.sha256(text.encode()).hexdigest() if digest else text
            d, p, t = aligned.entries()
            documents.append(own[d])
            pairs.append(p)
            times.append(t)
        of = np.concatenate(documents) if documents else np.zeros(0, dtype=np.int64)
        order = np.argsort(of, kind="stable")
        if len(order):
            self.pairs.append(np.concatenate(pairs)[order])
            self.times.append(np.concatenate(times)[order])
        self.sizes.append(np.bincount(of, minlength=n))
        self.ids += ids
        self.numbers.append(numbers)
        self.groups += groups
        self.links += int(numbers[:, 3].sum())

    def row(self, block: int) -> pd.DataFrame:
        none = np.zeros(0, dtype=np.int64)
        kinds, codes, holders = np.unique(np.concatenate(self.pairs) if self.pairs else none, return_inverse=True, return_counts=True)
        press = zstandard.ZstdCompressor(level=1).compress
        absent = np.array([i is None for i in self.ids])
        ids = np.where(absent, 0, np.array([0 if i is None else i for i in self.ids], dtype="<i8"))
        row = (
            block, len(self.ids), ids.astype("<i8").tobytes() + np.packbits(absent).tobytes(), _packed(np.concatenate(self.numbers).ravel()),
            press("\n".join(self.groups).encode()), _packed(np.concatenate(self.sizes)), _packed(np.diff(codes, prepend=0) & 0xFFFFFFFF),
            _packed(np.concatenate(self.times) if self.times else none), press(kinds.astype("<i8").tobytes()), _packed(holders),
        )
        return pd.DataFrame([row], columns=[c.split()[0] for c in BLOCKS.split(", ")])


def write_blocks(docs: DataFrame, path: str, id_col: str, text_col: str, byte_vocabulary: str | None, piece_vocabulary: str | None, digest: bool) -> None:
    def blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool = aligner(byte_vocabulary or public_tokenizers.path(BYTE_VOCABULARY), piece_vocabulary or public_tokenizers.path(PIECE_VOCABULARY))
        held, number = Block(), 0
        for frame in frames:
            for _, some in frame.groupby(frame["body"].str.len().cumsum() // CHARACTERS, sort=True):
                held.add([None if i is None else int(i) for i in some["doc_id"]], some["body"].tolist(), tool, digest)
                if held.links >= BLOCK:
                    yield held.row(TaskContext.get().partitionId() << 32 | number)
                    held, number = Block(), number + 1
        if held.ids:
            yield held.row(TaskContext.get().partitionId() << 32 | number)

    # Ids travel as text: pandas would make fractions of numbers among nulls.
    rows = docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    rows.mapInPandas(blocks, BLOCKS).write.parquet(path)


def _pairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for row in frame.itertuples():
            kinds = np.frombuffer(zstandard.ZstdDecompressor().decompress(row.pairs), dtype="<i8")
            yield pd.DataFrame({"block": row.block, "pair": kinds, "n": _unpacked(row.holders)})


def _told(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Documents of a block, with the counts of its pairs."""
    right = right.sort_values("pair")
    count, best = right["held"].to_numpy(dtype=np.int64), right["best"].to_numpy(dtype=bool)
    out = []
    for row in left.itertuples():
        times, codes = _unpacked(row.times), np.cumsum(_unpacked(row.codes)) & 0xFFFFFFFF
        ends = np.concatenate(([0], np.cumsum(_unpacked(row.entries))))
        summed = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[ends])
        n = int(row.docs)
        ids = pd.Series(np.frombuffer(row.doc_ids[: 8 * n], dtype="<i8")).astype("Int64")
        absent = np.unpackbits(np.frombuffer(row.doc_ids[8 * n :], dtype=np.uint8), count=n) == 1
        numbers = _unpacked(row.numbers).reshape(n, 4)
        frame = pd.DataFrame(numbers, columns=NUMBERS)
        frame.insert(0, "doc_id", ids.mask(absent))
        frame["n_best"], frame["count_sum"] = summed(times * best[codes]), summed(times * count[codes])
        frame["groups"] = zstandard.ZstdDecompressor().decompress(row.groups).decode().split("\n")
        out.append(frame)
    return pd.concat(out) if out else pd.DataFrame(columns=[c.split()[0] for c in ROWS.split(", ")])


def align(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_vocabulary: str | None = None, piece_vocabulary: str | None = None, digest: bool = False
) -> DataFrame:
    """Per document: ROWS. ``groups`` spells the groups, as ``a1,a2|b1;a3|b2,b3``, or is the SHA-256 of that; empty without tokens.

    ``n_best`` counts the links whose pair is in as many documents as any pair of the same
    first id, ``count_sum`` adds up the documents of the pairs of all links.
    """
    spark = docs.sparkSession
    path, where = fresh_path(spark, "blocks"), fresh_path(spark, "pairs")
    write_blocks(docs, path, id_col, text_col, byte_vocabulary, piece_vocabulary, digest)
    blocks = spark.read.parquet(path)
    blocks.select("block", "pairs", "holders").mapInPandas(_pairs, "block long, pair long, n long").write.parquet(where)
    pairs = spark.read.parquet(where)
    held = pairs.groupBy("pair").agg(F.sum("n").alias("held"))
    # A window holds the pairs of one first id, at most as many as the second vocabulary has ids.
    first = Window.partitionBy(F.shiftright("pair", SHIFT))
    counted = held.withColumn("best", F.col("held") == F.max("held").over(first))
    back = pairs.select("block", "pair").join(counted, "pair")
    return blocks.drop("pairs", "holders").groupBy("block").cogroup(back.groupBy("block")).applyInPandas(_told, ROWS)
