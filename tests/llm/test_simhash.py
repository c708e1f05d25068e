from __future__ import annotations

import random
import re

import xxhash
from odd_rows import ODD, prose

from meterline.llm import simhash
from meterline.llm.links import roots

LOWER = {i: i + 32 for i in range(65, 91)}


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, bits=3):
    parent = list(range(len(prints)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                parent[top(i)] = top(j)
    return [top(i) for i in range(len(prints))]


def near_copies(n):
    base = prose(1, 400).split()
    out = []
    for k in range(n):
        words = list(base)
        words[k * 7 % 400] = f"new{k}"
        out.append((200 + k, " ".join(words)))
    return out


def test_against_all_pairs(make_docs):
    rows = ODD + near_copies(25) + [(300 + i, prose(i, 30)) for i in range(20)] + [(400 + i, "copy of one text") for i in range(40)]
    got = simhash.components(make_docs(*rows)).collect()
    prints = [plain(t) for _, t in rows]
    groups = components(prints)
    least = {}
    for (i, _), g in zip(rows, groups):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    want = sorted(((i, f"{p:016x}", least.get(g)) for (i, _), p, g in zip(rows, prints, groups)), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want


def test_links_lose_no_pair(spark):
    rng = random.Random(5)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for p in list(prints):
        for bits in (1, 2, 3, 4):
            q = p
            for b in rng.sample(range(64), bits):
                q ^= 1 << b
            prints.append(q)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in set(signed)], "fp long")
    for bits in (0, 1, 3, 7):
        got = {frozenset(r) for r in simhash.links(df, bits).collect()}
        want = {frozenset((a, b)) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= bits}
        assert got == want


def test_roots_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(10, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = dict(roots(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 10 for i in range(10, 61)}, **{100 + i: 100 for i in range(40)}, 200: 200, 201: 200, 202: 200}


def test_one_of_each_group_stays(make_docs):
    rows = ODD + [(400 + i, "copy of one text") for i in range(9)]
    kept = simhash.keep_one(make_docs(*rows))
    assert kept.columns == make_docs(*rows).columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(5) == 0 and ids.count(4) == 1 and 400 in ids and 401 not in ids and 1 in ids and 2 not in ids


def test_one_row_of_each_component_stays_whatever_its_id(make_docs):
    first, second, third, other = (prose(900 + i, 40) for i in range(4))
    rows = [(None, first), (None, second), (None, third), (None, third), (5, first), (7, other), (7, second), (8, second), (9, other)]
    kept = simhash.keep_one(make_docs(*rows))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(5, first), (7, other), (7, second), (None, third)], key=str
    )
    again = simhash.keep_one(make_docs(*rows[::-1]).repartition(3))
    assert sorted(map(str, again.collect())) == sorted(map(str, kept.collect()))


def test_no_rows(make_docs):
    df = make_docs(*ODD).limit(0)
    assert simhash.components(df).count() == 0 and simhash.keep_one(df).count() == 0
