"""Runs of periodic text, found in tiles sized by the octave of the period.

A run is a stretch of words in which words ``period`` apart are identical, that no
neighbouring word extends, and that holds at least ``min_exponent`` periods and
``min_length`` words. Written as pairs (i, i + period) of identical words, a run of
period p is one interval of such i.

For the octave of periods [2^k, 2^(k+1)) a document has a boundary every S words, S so
small that the pairs of any run begin at most S - 1 words before some boundary and go on
for at least S words behind it. A tile holds many boundaries and, left and right, what the
intervals at its boundaries may reach: S pairs back, 2 S pairs ahead. Small octaves share
tiles; larger ones have tiles of their own. Every tile is solved by itself: a lag counts
as a candidate at a boundary where the S words there recur, and the Z-functions of the
text behind the boundary and of the reversed text before it say how far the pairs go.
An interval that ends inside its reach is complete and stays only if it is long enough;
one that reaches further is a fragment. Tiles of a document longer than a tile are dealt
out over all tasks. Fragments meet by document and period, and overlapping or touching
ones are stitched, which is exact, as intervals of pairs are.

A run's smallest period divides all its other periods of at most half its length, so of
equal stretches the one with the least period is the run.

Words are compared by number within a tile; Z values come from a polynomial hash modulo a
Mersenne prime and every interval that a tile returns is then compared word by word.

Defined cases: a null or empty text has no words and no runs; rows that repeat an id are
found each by its own text; a null id is like any other; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterline.scratch import fresh_path

MIN_LENGTH = 24
MIN_EXPONENT = 3
TILE = 1 << 13  # boundaries of a tile, in words
FEWEST = 16  # boundaries of a tile, in steps

PIECES = "array<struct<period:long,start:long,stop:long>>"
TILES = f"key string, doc_id string, body string, first boolean, n_words long, lo int, hi int, core long, at long, words binary, pieces {PIECES}"
COLUMNS = ["key", "doc_id", "body", "first", "n_words", "lo", "hi", "core", "at", "words", "pieces"]
RUNS = "array<struct<start:long,length:long,period:long>>"

# Fixed values of the hash: a Mersenne prime, a base below it, and an odd multiplier.
PRIME = np.uint64((1 << 61) - 1)
BASE = 0x0B4711F3A96E35D1
ODD = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=None)
def step(k: int, min_length: int, min_exponent: int) -> int:
    """Words between boundaries: the largest power of two S for which any run of the octave, or of a later one, has 2 S - 1 pairs."""
    least = max(1 << k, min_length // min_exponent)
    fewest = min(max(min_length - q, (min_exponent - 1) * q) for q in (least, least + 1))
    return 1 << ((fewest + 1) // 2).bit_length() - 1


def tiles(n: int, min_length: int, min_exponent: int, tile: int) -> list[tuple[int, int, int, int, int, int]]:
    """(lo, hi, core, stop, at, end) of every tile: its octaves, its boundaries [core, stop), its words [at, end)."""
    top = n // min_exponent
    if n < min_length or top < 1:
        return []
    groups: list[list[int]] = []
    shared = 0
    for k in range(top.bit_length()):
        small = FEWEST * step(k, min_length, min_exponent) <= tile
        if groups and small and groups[-1][1] == k - 1 and shared:
            groups[-1][1] = k
        else:
            groups.append([k, k])
        shared = small
    out = []
    for lo, hi in groups:
        widest = step(hi, min_length, min_exponent)
        core = max(tile, FEWEST * widest)
        for at in range(0, n, core):
            out.append((lo, hi, at, min(at + core, n), max(0, at - widest), min(n, at + core + 2 * widest + (2 << hi))))
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo the prime, from halves of 31 bits."""
    low, half = np.uint64((1 << 31) - 1), np.uint64(31)
    ah, al, bh, bl = a >> half, a & low, b >> half, b & low
    middle = ah * bl + al * bh
    whole = (ah * bh << np.uint64(1)) + (middle >> np.uint64(30)) + ((middle & np.uint64((1 << 30) - 1)) << half) + al * bl
    return _reduced(whole)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & PRIME) + (x >> np.uint64(61))
    return np.where(x >= PRIME, x - PRIME, x)


@lru_cache(maxsize=4)
def _powers(size: int) -> np.ndarray:
    out = np.ones(size, dtype=np.uint64)
    have, factor = 1, BASE
    while have < size:
        more = min(have, size - have)
        out[have : have + more] = _product(out[:more], np.uint64(factor))
        factor = factor * factor % int(PRIME)
        have += more
    return out


class Hashed:
    """Equality of stretches of a tile, by prefix sums of a polynomial."""

    def __init__(self, words: np.ndarray):
        self.power = _powers(1 << max(10, len(words).bit_length()))
        mixed = (words.astype(np.uint64) + np.uint64(1)) * ODD
        terms = _product(_reduced(mixed), self.power[: len(words)])
        half = np.uint64(31)
        low = np.cumsum(terms & np.uint64((1 << 31) - 1))
        high = _reduced(np.cumsum(terms >> half))
        # high * 2^31, and 2^61 is 1.
        shifted = (high >> np.uint64(30)) + ((high & np.uint64((1 << 30) - 1)) << half)
        self.before = np.concatenate((np.zeros(1, dtype=np.uint64), _reduced(_reduced(low) + _reduced(shifted))))

    def same(self, a: np.ndarray, lag: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the stretches of a size at a and at a + lag are equal."""
        one = self.before[a + size] + PRIME - self.before[a]
        two = self.before[a + lag + size] + PRIME - self.before[a + lag]
        return _product(_reduced(one), self.power[lag]) == _reduced(two)

    def common(self, a: np.ndarray, lag: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """The Z-functions: how far a and a + lag agree, ahead from there or back, at most ``most`` words."""
        found = np.zeros(len(a), dtype=np.int64)
        for m in range(int(most.max(initial=0)).bit_length() - 1, -1, -1):
            size = 1 << m
            fits = found + size <= most
            at = a - found - size if back else a + found
            at = np.where(fits, at, 0)
            got = fits & self.same(at, np.where(fits, lag, 0), np.where(fits, size, 0))
            found += got * size
        return found


@lru_cache(maxsize=24)
def _factors(bits: int) -> np.ndarray:
    """The least prime factor of every number below 2^bits."""
    out = np.arange(1 << bits, dtype=np.int64)
    for f in range(2, 1 << (bits + 1) // 2):
        if out[f] == f:
            of = out[f * f :: f]
            of[of == np.arange(f * f, 1 << bits, f)] = f
    return out


def _divided(hashed: Hashed, a: np.ndarray, lag: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the stretch a, a + size has a smaller period that divides lag; such a one belongs to that period."""
    least = _factors(int(lag.max()).bit_length())
    found, rest = np.zeros(len(a), dtype=bool), lag.copy()
    while (more := np.flatnonzero((rest > 1) & ~found)).size:
        factor = least[rest[more]]
        period = lag[more] // factor
        found[more] = hashed.same(a[more], period, size[more] - period)
        while (again := rest[more] % factor == 0).any():
            rest[more] = np.where(again, rest[more] // factor, rest[more])
    return found


def _checked(words: np.ndarray, at: int, lag: int, back: int, ahead: int) -> tuple[int, int]:
    """The Z values, word by word."""
    pairs = words[at - back : at + ahead] == words[at - back + lag : at + ahead + lag]
    if pairs.all():
        return back, ahead
    left, right = np.flatnonzero(~pairs[:back]), np.flatnonzero(~pairs[back:])
    return (back - 1 - int(left[-1]) if left.size else back), (int(right[0]) if right.size else ahead)


def solve(words: np.ndarray, at: int, n: int, lo: int, hi: int, core: int, stop: int, min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """(period, start, stop) of intervals of pairs at the boundaries of a tile, complete ones and fragments."""
    out: list[tuple[int, int, int]] = []
    block = (words.astype(np.uint64) + np.uint64(1)) * ODD
    size, hashed = 1, None
    for gap, octaves in groupby(range(lo, hi + 1), lambda k: step(k, min_length, min_exponent)):
        ks = list(octaves)
        first, final = 1 << ks[0], min((2 << ks[-1]) - 1, n // min_exponent)
        while size < gap:  # a name of twice as many words, from two names
            block = block[: max(0, len(block) - size)] * ODD + (block[size:] ^ (block[size:] >> np.uint64(29)))
            size *= 2
        places = np.arange(-(-core // gap) * gap, stop, gap) - at
        places = places[places + first < len(block)]
        if not len(places):
            break
        lags = final - first + 1
        padded = np.concatenate((block[places[0] + first :], np.zeros(lags, dtype=np.uint64)))
        rows = np.ndarray((len(places), lags), np.uint64, padded, strides=(8 * gap, 8))  # the blocks at all lags of each boundary
        which, lag = np.nonzero(rows == block[places][:, None])
        a, lag = places[which], lag + first
        inside = a + lag < len(block)
        a, lag = a[inside], lag[inside]
        if not len(a):
            continue
        hashed = hashed or Hashed(words)
        ahead_most = np.minimum(2 * gap, n - at - a - lag)
        back_most = np.minimum(gap, a + at)
        ahead = hashed.common(a, lag, ahead_most, back=False)
        back = hashed.common(a, lag, back_most, back=True)
        goes_on = ((ahead == 2 * gap) & (at + a + lag + ahead < n)) | ((back == gap) & (at + a - back > 0))
        enough = back + ahead >= np.maximum(min_length - lag, (min_exponent - 1) * lag)
        use = np.flatnonzero(goes_on | enough)
        if not use.size:
            continue
        a, lag, ahead, back = a[use], lag[use], ahead[use], back[use]
        own = ~_divided(hashed, a - back, lag, back + ahead + lag)
        for x, q, r, s in zip(a[own].tolist(), lag[own].tolist(), ahead[own].tolist(), back[own].tolist()):
            s, r = _checked(words, x, q, s, r)
            if r + s:
                out.append((q, at + x - s, at + x + r))
    return sorted(set(out))


def _numbered(words: list[bytes]) -> np.ndarray:
    numbers: dict[bytes, int] = {}
    return np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype="<i4", count=len(words))


def _pieces(found: list[tuple[int, int, int]]) -> list[dict[str, int]]:
    return [{"period": q, "start": s, "stop": e} for q, s, e in found]


def _write_tiles(docs: DataFrame, path: str, id_col: str, text_col: str, min_length: int, min_exponent: int, tile: int) -> None:
    """A first row for each document; one that fits a tile is solved, others have a row for each tile too."""

    def explode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows: list[tuple] = []
            for key, doc_id, text in zip(frame["key"], frame["doc_id"], frame["body"]):
                words = text.encode("utf-8", "surrogatepass").split()
                n, body = len(words), b" ".join(words).decode("utf-8", "surrogatepass")
                cut = tiles(n, min_length, min_exponent, tile)
                numbers = _numbered(words) if cut else None
                pieces: list[tuple[int, int, int]] = []
                if n <= tile:
                    for lo, hi, core, stop, at, _ in cut:
                        pieces += solve(numbers, at, n, lo, hi, core, stop, min_length, min_exponent)
                rows.append((key, doc_id, body, True, n, None, None, None, None, None, _pieces(pieces)))
                if n > tile:
                    rows += [(key, None, None, False, n, lo, hi, core, at, numbers[at:end].tobytes(), None) for lo, hi, core, _, at, end in cut]
            out = pd.DataFrame(rows, columns=COLUMNS, dtype=object)
            yield out.astype({c: "Int64" for c in ("n_words", "lo", "hi", "core", "at")})

    body = F.coalesce(F.col(text_col), F.lit(""))
    doc_id = F.col(id_col).cast("string")
    key = F.sha2(F.concat_ws(":", F.coalesce(doc_id, F.lit("")), body), 256)
    rows = docs.select(key.alias("key"), doc_id.alias("doc_id"), body.alias("body"))
    rows.mapInPandas(explode, TILES).write.option("compression", "zstd").parquet(path)


def _solved(tiled: DataFrame, min_length: int, min_exponent: int, tile: int) -> DataFrame:
    """Solves tiles of long documents, dealt out one by one."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for row in frame.itertuples():
                widest = step(row.hi, min_length, min_exponent)
                stop = min(row.core + max(tile, FEWEST * widest), row.n_words)
                words = np.frombuffer(row.words, dtype="<i4")
                rows.append((row.key, _pieces(solve(words, row.at, row.n_words, row.lo, row.hi, row.core, stop, min_length, min_exponent))))
            yield pd.DataFrame(rows, columns=["key", "pieces"])

    dealt = tiled.select("key", "n_words", "lo", "hi", "core", "at", "words").repartition(F.xxhash64("key", "lo", "core"))
    return dealt.mapInPandas(run, f"key string, pieces {PIECES}")


def stitched(pieces: DataFrame) -> DataFrame:
    """(key, period, start, stop): overlapping and touching intervals of a key and period as one."""
    order = Window.partitionBy("key", "period").orderBy("start", "stop")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = pieces.distinct().withColumn("opens", F.coalesce(F.col("start") > reach, F.lit(True)).cast("int"))
    islands = opened.withColumn("island", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy("key", "period", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("island")


def _kept(body: pd.Series, runs: pd.Series) -> pd.Series:
    """Texts without the words of a run after its first period."""
    out = []
    for text, found in zip(body, runs):
        words = text.split(" ")
        change = np.zeros(len(words) + 1, dtype=np.int64)
        for r in found:
            change[r["start"] + r["period"]] += 1
            change[r["start"] + r["length"]] -= 1
        keep = np.cumsum(change)[:-1] == 0
        out.append(" ".join(w for w, k in zip(words, keep.tolist()) if k))
    return pd.Series(out, dtype=object)


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT, tile: int = TILE) -> DataFrame:
    """Per document: doc_id, n_words, runs (by start, then period), collapsed (its words, each run once).

    ``min_exponent`` is a whole number of at least two.
    """
    if min_exponent < 2:
        raise ValueError("a run has at least two periods")
    spark = docs.sparkSession
    path, where = fresh_path(spark, "tiles"), fresh_path(spark, "runs")
    _write_tiles(docs, path, id_col, text_col, min_length, min_exponent, tile)
    table = spark.read.parquet(path)
    dealt = _solved(table.filter(~F.col("first")), min_length, min_exponent, tile)
    pieces = table.filter("first AND size(pieces) > 0").select("key", "pieces").unionAll(dealt).select("key", F.inline("pieces"))
    length = F.col("stop") - F.col("start") + F.col("period")
    long_enough = length >= F.greatest(F.lit(min_length), min_exponent * F.col("period"))
    runs = stitched(pieces).filter(long_enough).groupBy("key", "start", length.alias("length")).agg(F.min("period").alias("period"))
    runs.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "length", "period"))).alias("found")).write.parquet(where)

    doc_id = F.col("doc_id").cast(docs.schema[id_col].dataType).alias("doc_id")
    none, done = F.array().cast(RUNS), (F.size("pieces") == 0) & (F.col("n_words") <= tile)
    rows = table.filter("first")
    plain = rows.filter(done).select(doc_id, "n_words", none.alias("runs"), F.col("body").alias("collapsed"))
    found = rows.filter(~done).select("key", "doc_id", "n_words", "body").join(spark.read.parquet(where), "key", "left")
    some = found.withColumn("runs", F.coalesce("found", none))
    return plain.unionAll(some.select(doc_id, "n_words", "runs", F.pandas_udf(_kept, "string")("body", "runs").alias("collapsed")))


def longest(runs: Column) -> Column:
    """Of runs by start and period, the first with the greatest length / period, exactly; null if there are none."""
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    return F.reduce(runs, F.lit(None).cast("struct<start:long,length:long,period:long>"), lambda best, r: F.when(better(best, r), r).otherwise(best))


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) in which every document that its id's checksum chooses ends in a repetition.

    The words from ``a`` on become the ``p`` words at ``a`` over and over; others stay as they are.
    """
    checksum = F.crc32(F.col(id_col).cast("string"))
    words = F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    held = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), checksum.alias("h"))
    chosen = (F.col("h") % 10 == 0) & F.col("h").isNotNull()
    by = held.withColumn("words", F.when(chosen, words)).withColumn("n", F.size("words")).withColumn("g", F.expr("h div 10"))
    by = by.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    again = F.array_join(F.transform("words", lambda _, i: F.get("words", place(i).cast("int"))), " ")
    return by.select("doc_id", F.when(F.col("n") > 0, again).otherwise(F.col("text")).alias("text"))
