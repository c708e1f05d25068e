"""Toxicity by compression distance: two zstandard dictionaries and the lengths they give.

Every text is cut into windows of one word and of two. A window is compressed with a
dictionary of toxic and one of ordinary text, between two fixed carriers that both dictionaries
hold; less the length of the carriers alone, the result is what the window itself costs. Where
the toxic dictionary explains a window (its cost is at most ``cost``) and the ordinary one
does not (its cost is at least ``gain`` higher), the window is a hit. Both thresholds are
calibrated on labelled texts, each measured with dictionaries it did not go into, and so is
the share of toxic texts among those with as many hits, which is the score.

Both dictionaries are trained on whole sampled texts, with the same budget. A window that
toxic texts have in far more settings (between other words; ``RATIO`` times as many for their
number) goes into the toxic dictionary alone, any other into the ordinary one; so some ordinary
or mislabelled texts with a toxic word do not take it away, and near copies teach nothing. Windows of two words are taken from toxic texts in which
no word stands out by itself. Equal texts count once.

Fitting uses a bounded sample of the labelled rows: at most ``SAMPLE`` texts a
class, each of at most ``LONGEST`` bytes, chosen by a hash of the id. Scoring covers every text and its whole length.

Defined cases: a null or empty text has no hits and the score of such texts; labels that
are null, or name no document, are not used; an id labelled both ways counts as toxic;
without labels of both classes every score is 0; rows that repeat an id each give a row;
an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Set
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 2500
FOLDS = 4
LONGEST = 1 << 15
BYTES = 1 << 16
LEVEL = 19
TOGETHER = 40
SHARED = 0.01
RATIO = 8
CUT = 0.7
COSTS = (0, 1, 2, 3, 4)
GAINS = (3, 4, 5, 6)
STEPS = (1, 2, 3, 5)
MEMO = 300_000

# Bytes that no text holds, so the carriers match only each other.
BEFORE = bytes(range(0xF8, 0x100)) + bytes(range(1, 9)) + bytes(range(0xF8, 0x100))
AFTER = bytes(range(0x0E, 0x1B)) + b"\xff\xfe\xfd\xfc\xfb\xfa\xf9"
PAIR, PAIRS = b" \xf8\xf9 ", b" \xfa\xf9 "
EDGES = re.compile(rb"^[^0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff]+$")


def windows(text: str | None) -> list[bytes]:
    """The words of a text, in lower case."""
    return (text or "").lower().encode("utf-8", "surrogatepass").split()


def bare(window: bytes) -> bytes:
    """A window without the marks around its word."""
    return EDGES.sub(b"", window)


@dataclass(frozen=True)
class Model:
    """Dictionaries, thresholds, and the score by number of hits (its last entry holds for more)."""

    toxic: bytes
    ordinary: bytes
    cost: int
    gain: int
    scores: tuple[float, ...]


class Meter:
    """What windows cost under both dictionaries."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.press = []
        for content in (toxic, ordinary):
            held = zstandard.ZstdCompressionDict(content + b" " + AFTER + BEFORE, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=LEVEL)
            tool = zstandard.ZstdCompressor(
                level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False
            )
            self.press.append((tool, len(tool.compress(BEFORE + b"  " + AFTER))))
        self.known: dict[bytes, tuple[int, int] | None] = {}
        # Which words follow which in the windows of two words of the toxic dictionary.
        self.led: dict[bytes, set[bytes]] = {}
        for pair in toxic.partition(PAIRS)[0].split(PAIR):
            if len(two := pair.split()) == 2:
                self.led.setdefault(two[0], set()).add(two[1])

    def _cost(self, which: int, window: bytes) -> int:
        tool, carriers = self.press[which]
        return len(tool.compress(BEFORE + b" " + window + b" " + AFTER)) - carriers

    def _found(self, word: bytes, weight: int = 1) -> tuple[int, int] | None:
        """(cost under the toxic dictionary, weighted gain over the ordinary one); None if it cannot be a hit."""
        if len(word) < GAINS[0]:
            return None
        cost = self._cost(0, word)
        if cost > COSTS[-1]:
            return None
        gain = (self._cost(1, word) - cost) * weight
        return (cost, gain) if gain >= GAINS[0] else None

    def measure(self, window: bytes) -> tuple[int, int] | None:
        """What a window of one word is found to be."""
        if window not in self.known:
            if len(self.known) >= MEMO:
                self.known.clear()
            self.known[window] = self._found(bare(window))
        return self.known[window]

    def _pairs(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """Windows of two words; only such as the toxic dictionary holds side by side can be cheap under it.

        The ordinary dictionary knows both words, so all that can be gained is one match in
        two: the gain counts double.
        """
        for one, two in zip(words, words[1:]):
            if one in self.led or (one := bare(one)) in self.led:
                two = bare(two)
                if two in self.led[one]:
                    pair = one + b" " + two
                    if pair not in self.known:
                        self.known[pair] = self._found(pair, 2)
                    if self.known[pair] is not None:
                        yield self.known[pair]

    def profile(self, text: str | None) -> Counter:
        """How many windows of a text have each (cost, gain)."""
        words = windows(text)
        found = Counter(m for m in map(self.measure, words) if m is not None)
        if self.led:
            found.update(self._pairs(words))
        return found


def hits(profile: Counter, cost: int, gain: int) -> int:
    return sum(n for (c, g), n in profile.items() if c <= cost and g >= gain)


def _dictionary(pieces: list[bytes], size: int, apart: Set[bytes] = frozenset()) -> bytes:
    """A dictionary trained on runs of pieces; of few pieces, the pieces themselves, the commonest last.

    There, pairs that are to be kept ``apart`` do not become neighbours by accident.
    """
    runs = [b" " + b" ".join(pieces[i : i + TOGETHER]) + b" " for i in range(0, len(pieces), TOGETHER)]
    distinct = [w for w, _ in reversed(Counter(pieces).most_common())]
    for i in range(1, len(distinct) - 1):
        if distinct[i - 1] + b" " + distinct[i] in apart:
            distinct[i], distinct[i + 1] = distinct[i + 1], distinct[i]
    plain = b" " + b" ".join(distinct) + b" "
    if len(plain) <= size or len(runs) < 64:
        return plain[-size:]
    try:
        return zstandard.train_dictionary(size, runs).as_bytes()
    except zstandard.ZstdError:
        return plain[-size:]


def _settings(texts: list[list[bytes]], wanted: Set[bytes]) -> Counter:
    """In how many settings a window stands: different words before and behind it, over all texts."""
    seen: dict[bytes, set[int]] = {}
    for words in texts:
        for i, w in enumerate(words):
            if w in wanted:
                seen.setdefault(w, set()).add(hash((words[i - 1] if i else b"", words[i + 1] if i + 1 < len(words) else b"")))
    return Counter({w: len(s) for w, s in seen.items()})


def _standing_out(toxic: list[list[bytes]], ordinary: list[list[bytes]], fewest: int) -> set[bytes]:
    """The windows that the toxic texts have in far more settings for their number, and in at least ``fewest``.

    Near copies repeat a window in one setting, so a group of them teaches nothing.
    """
    least = max(fewest, round(SHARED * len(toxic)))
    often = Counter(w for text in toxic for w in set(text))
    wanted = {w for w, n in often.items() if w and n >= least}
    have, others = _settings(toxic, wanted), _settings(ordinary, wanted)
    rate = (len(toxic) + 1) / (len(ordinary) + 1)
    return {w for w, n in have.items() if n >= least and n + 0.5 >= RATIO * rate * (others[w] + 0.5)}


def _paired(words: list[bytes], apart: set[bytes]) -> list[bytes]:
    return [a + b" " + b for a, b in zip(words, words[1:]) if a and b and a not in apart and b not in apart]


def _contents(rows: list[tuple[str, int]]) -> tuple[bytes, bytes] | None:
    """The toxic and the ordinary dictionary of labelled texts."""
    toxic, ordinary = ([[bare(w) for w in windows(t)] for t in dict.fromkeys(t for t, y in rows if bool(y) == side)] for side in (True, False))
    if not toxic or not ordinary:
        return None
    marked = _standing_out(toxic, ordinary, 2)
    unexplained = [t for t in toxic if not any(w in marked for w in t)]
    pairs = _standing_out([_paired(t, marked) for t in unexplained], [_paired(t, marked) for t in ordinary], 5)
    found = [w for t in toxic for w in t if w in marked]
    both = [p for t in unexplained for p in _paired(t, marked) if p in pairs]
    if not found and not both:  # too few texts to tell: what no ordinary text has
        plain = {w for t in ordinary for w in t}
        found = [w for t in toxic for w in t if w not in plain]
    named = PAIR.join(p for p, _ in Counter(both).most_common())
    if len(named) > BYTES // 2:
        named = named[: BYTES // 2].rpartition(PAIR)[0]
    return named + PAIRS + _dictionary(found, BYTES - len(named)), _dictionary([w for t in ordinary for w in t if w not in marked], BYTES, pairs)


def fit(rows: list[tuple[str, int]], folds: int = FOLDS) -> Model | None:
    """A model from texts with labels.

    Thresholds and scores come from texts measured with dictionaries of the other folds,
    the dictionaries of the model from all.
    """
    contents = _contents(rows)
    if contents is None:
        return None
    seen = []
    for k in range(folds):
        meter = Meter(*(_contents([r for i, r in enumerate(rows) if i % folds != k]) or contents))
        seen += [(meter.profile(t), y) for t, y in rows[k::folds]]
    positives = max(1, sum(y for _, y in seen))
    negatives = max(1, len(seen) - positives)

    def worth(cost: int, gain: int) -> float:
        found = [hits(p, cost, gain) > 0 for p, _ in seen]
        right = sum(f and y == 1 for f, (_, y) in zip(found, seen)) / positives
        wrong = sum(f and y == 0 for f, (_, y) in zip(found, seen)) / negatives
        return right - wrong

    cost, gain = max(((c, g) for c in COSTS for g in GAINS), key=lambda x: (worth(*x), x[1], -x[0]))
    by_step: list[list[int]] = [[0, 0] for _ in range(len(STEPS) + 1)]
    for profile, y in seen:
        n = hits(profile, cost, gain)
        by_step[sum(n >= s for s in STEPS)][y] += 1
    rates, best = [], 0.0
    for clean, bad in by_step:
        best = max(best, (bad + 0.5) / (clean + bad + 1) if rates else (bad + 0.05) / (clean + bad + 1))
        rates.append(best)
    table = tuple(rates[sum(n >= s for s in STEPS)] for n in range(STEPS[-1] + 1))
    return Model(*contents, cost, gain, table)


@lru_cache(maxsize=1)
def _meter(toxic: bytes, ordinary: bytes) -> Meter:
    return Meter(toxic, ordinary)


def sample(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str, text_col: str, label_col: str, size: int) -> list[tuple[str, int]]:
    """(text, label) for :func:`fit`, at most ``size`` of each label, chosen by a hash of the id."""
    known = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y"))
        .filter("id IS NOT NULL AND y IS NOT NULL")
        .groupBy("id")
        .agg(F.max(F.when(F.col("y") > 0, 1).otherwise(0)).alias("y"))
        .withColumn("turn", F.xxhash64("id"))
    )
    known = known.filter(usable)
    drawn = known.filter("y = 1").orderBy("turn").limit(size).unionAll(known.filter("y = 0").orderBy("turn").limit(size))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.octet_length("text") <= LONGEST)
    # At most 2 * size rows of two numbers are broadcast, and as many texts come back: one for each id.
    met = texts.join(F.broadcast(drawn), "id").groupBy("id", "y", "turn").agg(F.min("text").alias("text"))
    rows = met.collect()
    rows.sort(key=lambda r: (r["turn"], r["id"], r["text"]))
    return [(r["text"], r["y"]) for r in rows]


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, score, predicted, n_hits."""

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        meter = _meter(model.toxic, model.ordinary)
        for texts in batches:
            yield pd.Series([hits(meter.profile(t), model.cost, model.gain) for t in texts], dtype="int64")

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("body"))
    if model is None:
        scored = rows.select("doc_id", F.lit(0).cast("long").alias("n_hits"), F.lit(0.0).alias("score"))
    else:
        table = F.array(*[F.lit(float(s)) for s in model.scores])
        counted = rows.select("doc_id", F.pandas_udf(count, "long")(F.col("body")).alias("n_hits"))
        scored = counted.withColumn("score", F.element_at(table, F.least(F.col("n_hits"), F.lit(len(model.scores) - 1)).cast("int") + 1))
    return scored.select("doc_id", "score", (F.col("score") >= CUT).cast("int").alias("predicted"), "n_hits")


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row's label may not be learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", size: int = SAMPLE) -> DataFrame:
    """Fit on labelled rows that are not held out, and score every document."""
    rows = sample(docs, labels, ~held_out("id"), id_col, text_col, label_col, size)
    return score(docs, fit(rows), id_col, text_col)


def keep_mild(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """The documents that are not predicted toxic, with their own columns; rows that repeat an id are judged one by one."""
    model = fit(sample(docs, labels, ~held_out("id"), id_col, text_col, label_col, SAMPLE))
    if model is None:
        return docs
    bad = {n for n, s in enumerate(model.scores) if s >= CUT}

    def mild(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        meter, last = _meter(model.toxic, model.ordinary), len(model.scores) - 1
        for texts in batches:
            yield pd.Series([min(last, hits(meter.profile(t), model.cost, model.gain)) not in bad for t in texts], dtype=bool)

    return docs.filter(F.pandas_udf(mild, "boolean")(F.col(text_col)))
