from __future__ import annotations

import random
import zlib

import pytest
from odd_rows import ODD, prose

from meterline.llm import toxicity

BAD = ["grubble", "snarkfoot", "mudwhistle", "blatherskite"]


def rows(n=600):
    rng = random.Random(9)
    out = []
    for i in range(1000, 1000 + n):
        words = prose(i, 60).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", ".", ","]))
        out.append((i, " ".join(words), int(toxic)))
    return out


def crc(i):
    return zlib.crc32(str(i).encode()) % 3


@pytest.fixture(scope="module")
def tables(spark, make_docs):
    made = rows()
    docs = make_docs(*ODD, *[(i, t) for i, t, _ in made])
    labels = spark.createDataFrame(
        [(i, 1, y) for i, _, y in made] + [(None, 0, 1), (5, 0, None), (99999, 0, 1)], "doc_id long, quality int, toxic int"
    )
    return docs, labels, {i: y for i, _, y in made}


def test_held_out_labels_are_predicted(tables):
    docs, labels, truth = tables
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == len(truth) + len(ODD)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    held = [(truth[r.doc_id], r.predicted) for r in got if r.doc_id in truth and crc(r.doc_id) == 1]
    assert sum(y == p for y, p in held) / len(held) > 0.95
    assert not any(r.predicted for r in got if r.doc_id not in truth)


def test_held_out_labels_are_not_used(spark, tables):
    docs, labels, truth = tables
    turned = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(), 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")))
    key = lambda df: sorted((str(r.doc_id), r.score) for r in df.collect())
    assert key(toxicity.classify(docs, labels)) == key(toxicity.classify(docs, turned))


def test_stage_keeps_mild_documents(tables):
    docs, labels, truth = tables
    kept = toxicity.keep_mild(docs, labels)
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == docs.columns
    assert {i for i, _ in ODD} <= ids
    assert sum(truth[i] for i in ids if i in truth) < 0.1 * sum(truth.values())


def test_without_labels_or_rows(spark, tables):
    docs, labels, _ = tables
    few = docs.limit(5)
    assert {r.score for r in toxicity.classify(few, labels.limit(0)).collect()} == {0.0}
    assert toxicity.classify(docs.limit(0), labels).count() == 0
    assert toxicity.keep_mild(few, labels.filter("toxic = 0")).count() == 5


def test_windows_cost_less_with_their_own_dictionary():
    meter = toxicity.Meter(b" ".join(w.encode() for w in BAD), b" ".join(prose(1, 300).encode().split()))
    assert all(meter.measure(w.encode()) is not None for w in BAD)
    assert meter.measure(b"be") is None and meter.measure("漢字漢字".encode()) is None


def judged(made: list[tuple[str, int]]) -> tuple[float, float]:
    """Recall and the share of clean texts left alone, on the half that was not learned from."""
    model = toxicity.fit(made[::2])
    meter = toxicity.Meter(model.toxic, model.ordinary)
    scores = [(model.scores[min(len(model.scores) - 1, toxicity.hits(meter.profile(t), model.cost, model.gain))], y) for t, y in made[1::2]]
    bad, good = [s for s, y in scores if y], [s for s, y in scores if not y]
    return sum(s >= toxicity.CUT for s in bad) / len(bad), sum(s < toxicity.CUT for s in good) / len(good)


def labelled(n: int, spoil) -> list[tuple[str, int]]:
    rng = random.Random(21)
    out = []
    for i in range(n):
        words, toxic = prose(5000 + i, 60).split(), rng.random() < 0.3
        out.append((" ".join(spoil(words, toxic, rng)), int(toxic)))
    return out


def test_toxic_words_that_leak_into_ordinary_texts():
    def spoil(words, toxic, rng):
        for _ in range(4 if toxic else rng.random() < 0.02):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        return words

    recall, alone = judged(labelled(1200, spoil))
    assert recall > 0.95 and alone > 0.95


def test_toxic_phrases_of_ordinary_words():
    phrases = [("catdog", "elmfig"), ("gemhut", "inkjet"), ("kinlog", "mapnet")]

    def spoil(words, toxic, rng):
        for _ in range(4):
            one, two = rng.choice(phrases)
            if toxic:
                at = rng.randrange(len(words))
                words[at:at] = [one, two]
            else:
                words.insert(rng.randrange(len(words)), rng.choice([one, two]))
        return words

    recall, alone = judged(labelled(1200, spoil))
    assert recall > 0.95 and alone > 0.95


def test_mislabelled_texts():
    def spoil(words, toxic, rng):
        for _ in range(4 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        return words

    rng = random.Random(3)
    made = labelled(1200, spoil)
    learned = [(t, 1 - y if rng.random() < 0.03 else y) for t, y in made[::2]]
    recall, alone = judged([x for pair in zip(learned, made[1::2]) for x in pair])
    assert recall > 0.95 and alone > 0.95


def test_texts_with_a_common_opening_all_teach():
    made = [("the same opening words of all " + t, y) for t, y in labelled(800, lambda w, toxic, rng: [*w, *([rng.choice(BAD)] * 3 if toxic else [])])]
    recall, alone = judged(made)
    assert recall > 0.95 and alone > 0.95


def test_the_sample_is_bounded_by_texts(spark, make_docs):
    docs = make_docs(*[(1, f"text {i}") for i in range(500)], *[(2, f"other {i}") for i in range(500)])
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    rows = toxicity.sample(docs, labels, toxicity.F.lit(True), "doc_id", "text", "toxic", 1)
    assert sorted(rows) == [("other 0", 0), ("text 0", 1)]
