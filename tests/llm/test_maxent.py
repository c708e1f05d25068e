from __future__ import annotations

import collections
import math
import re
import zlib

import numpy as np
import pytest
from odd_rows import ODD, WORDS, prose

from meterline.llm import maxent

LOWER = {i: i + 32 for i in range(65, 91)}


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + [" "]


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def chained(seed, n):
    """Words of which each nearly decides the next."""
    rng = np.random.default_rng(seed)
    out, at = [], int(rng.integers(len(WORDS)))
    for _ in range(n):
        out.append(WORDS[at])
        at = (at * 3 + 1) % len(WORDS) if rng.random() < 0.9 else int(rng.integers(len(WORDS)))
    return " ".join(out)


def test_base_scores_and_counts(make_docs):
    rows = ODD + [(100 + i, prose(i, 30) + " The THE the") for i in range(60)]
    count = collections.Counter(w for i, t in rows if not held_out(i) for w in tokens(t))
    total, kinds = sum(count.values()), len(count)
    got = maxent.score(make_docs(*rows)).collect()
    want = []
    for i, t in rows:
        w = tokens(t)
        base = sum(math.log10((count[x] + 0.5) / (total + 0.5 * (kinds + 1))) for x in w)
        want.append((i, held_out(i), len(w), sum(count[x] > 0 for x in w), total, round(base, 6)))
    assert sorted(((*r[:5], round(r.base_score, 6)) for r in got), key=str) == sorted(want, key=str)
    assert all(r.score < 0 for r in got)


def test_model_learns_what_the_base_cannot(make_docs):
    rows = [(i, chained(i, 150)) for i in range(500)]
    got = [r for r in maxent.score(make_docs(*rows)).collect() if r.held_out]
    per_token = lambda c: sum(r[c] for r in got) / sum(r.n_tokens for r in got)
    assert per_token("score") > per_token("base_score") + 0.15


def test_probabilities_add_up():
    rng = np.random.default_rng(0)
    weights = maxent.Weights(
        rng.normal(size=(maxent.ROWS, maxent.CLASSES)).astype(np.float32), rng.normal(size=(maxent.ROWS, maxent.SLOTS)).astype(np.float32),
        rng.normal(size=maxent.CLASSES).astype(np.float32), rng.normal(size=(maxent.CLASSES, maxent.SLOTS)).astype(np.float32),
    )
    mixed = rng.integers(0, 1 << 63, (1, maxent.FEATURES), dtype=np.uint64)
    total = 0.0
    for c in range(maxent.CLASSES):
        classes, slots, _, _ = weights.probabilities(mixed, np.array([c]))
        total += float(classes[0, c] * slots[0].sum())
    assert total == pytest.approx(1, abs=1e-5)


def test_no_training_rows_and_no_rows(make_docs):
    ids = [i for i in range(200) if held_out(i)][:3]
    got = maxent.score(make_docs(*[(i, "a b c") for i in ids])).collect()
    assert [(r.n_known, r.train_tokens, r.base_score) for r in got] == [(0, 0, 0.0)] * 3
    assert maxent.score(make_docs(*ODD).limit(0)).count() == 0
