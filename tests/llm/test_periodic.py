"""Runs against a search over all periods, tile sizes that cut documents, and the query by its contract."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from odd_rows import ODD, prose

from meterline.llm import periodic, queries


def all_runs(words: list, min_length: int = 24, min_exponent: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, period by period."""
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    codes, n, found = np.array([numbers[w] for w in words]), len(words), {}
    for q in range(1, n // min_exponent + 1):
        edges = np.diff(np.concatenate(([0], (codes[:-q] == codes[q:]).astype(int), [0])))
        for start, stop in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()):
            length = stop - start + q
            if length >= max(min_length, min_exponent * q):
                found.setdefault((start, length), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repeated(rng: random.Random, n: int, kinds: int) -> list[str]:
    words = [f"w{rng.randrange(kinds)}" for _ in range(n)]
    for _ in range(rng.randint(0, 4) if n > 30 else 0):
        a = rng.randrange(n)
        p = rng.randint(1, max(1, (n - a) // 3))
        for i in range(a, min(n, a + rng.randint(3, 9) * p)):
            words[i] = words[a + (i - a) % p]
    return words


def rows_of(df) -> list[tuple]:
    got = [(r.doc_id, r.n_words, [(x.start, x.length, x.period) for x in r.runs], r.collapsed) for r in df.collect()]
    return sorted(got, key=lambda r: (r[0] is None, r[0] or 0, r[3]))


def expected(rows, **limits) -> list[tuple]:
    out = []
    for doc_id, text in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        runs = all_runs(words, **limits)
        out.append((doc_id, len(words), runs, collapsed(words, runs)))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[3]))


@pytest.mark.parametrize("tile", [16, 64, 8192])
@pytest.mark.parametrize(("min_length", "min_exponent"), [(24, 3), (1, 2), (100, 2), (7, 5)])
def test_any_tile_size_finds_all_runs(spark, make_docs, tile, min_length, min_exponent):
    rng = random.Random(tile + min_length)
    rows = [(i, " ".join(repeated(rng, rng.randint(0, 400), rng.choice([1, 2, 3, 50])))) for i in range(40)]
    got = periodic.find_runs(make_docs(*rows), min_length=min_length, min_exponent=min_exponent, tile=tile)
    assert rows_of(got) == expected(rows, min_length=min_length, min_exponent=min_exponent)


def test_odd_rows_and_shapes(spark, make_docs):
    line = prose(3, 40)
    rows = [
        *ODD, (20, " ".join(["same"] * 3000)), (21, " ".join([line] * 30)), (22, " ".join(["a b"] * 11 + ["a"])), (23, " ".join(["a b"] * 12)),
        (24, f"{prose(1, 50)}\n{line} {line}\t{line} {prose(2, 9)}"), (24, f"{line} {line} {line}"), (None, " ".join([line] * 4)),
        (25, " ".join((["x"] * 30 + ["y"]) * 5)),
    ]
    assert rows_of(periodic.find_runs(make_docs(*rows), tile=256)) == expected(rows)
    assert periodic.find_runs(make_docs((1, "a")).limit(0)).count() == 0
    with pytest.raises(ValueError, match="two periods"):
        periodic.find_runs(make_docs((1, "a")), min_exponent=1)


def test_hash_of_stretches_is_exact_on_structured_words():
    # The Thue-Morse word, which defeats polynomial hashes modulo a power of two.
    words = np.array([bin(i).count("1") % 2 for i in range(1 << 12)], dtype=np.int32)
    hashed = periodic.Hashed(words)
    for lag in (1, 2, 3, 1024, 2048):
        ahead = hashed.common(np.array([0, 5]), np.array([lag, lag]), np.array([900, 900]), back=False)
        for a, n in zip((0, 5), ahead.tolist()):
            assert (words[a : a + n] == words[a + lag : a + lag + n]).all() and (n == 900 or words[a + n] != words[a + lag + n])


def test_query_by_its_contract(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for doc_id, text in docs:
        words = [w.decode() for w in (text or "").encode().split()]
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = all_runs(words)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        milli = None if best[0] is None else 1000 * best[1] // best[2]
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        want.append((doc_id, len(runs), *best, milli, digest(lines), digest(collapsed(words, runs))))
    got = queries.registered()["op11_periodic_runs"](spark, small)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert sum(r[1] for r in want) > 10
