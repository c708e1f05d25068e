from __future__ import annotations

import random
import re

import pytest
from compare import plan_text
from odd_rows import prose
from pyspark.sql import functions as F

from meterline.llm import mixing


def rows(n=400):
    rng = random.Random(3)
    sources = ["a", "a", "a", "b", "c", "é", None]
    made = [(i, prose(i, rng.choice([1, 5, 20, 60])), rng.choice(sources)) for i in range(n)]
    return made + [(n, None, "a"), (n + 1, "", None), (n + 2, " \n", "empty"), (3, "again one", "b"), (None, "no id here", "b")]


def targets(sizes):
    """By the rule: share out by weight, stop at twice the size, share the excess again."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, stopped = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in stopped]
        left = total - sum(stopped.values())
        heavy = sum(weight[s] for s in rest)
        over = [s for s in rest if left * weight[s] / heavy > 2 * sizes[s]]
        if not over:
            return stopped | {s: left * weight[s] / heavy for s in rest}
        stopped |= {s: 2 * sizes[s] for s in over}


def test_mix_meets_its_targets(make_docs):
    docs = make_docs(*rows())
    found = mixing.mix(docs, leaf=50, fan=3).collect()
    assert len(found) == len(rows())
    sizes = {}
    for _, t, s in rows():
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in found:
        assert r.taken == r.copies * r.size and r.taken <= 2 * r.size
        assert r.source_size == sizes[r.src] and r.target == pytest.approx(want[r.src])
        taken[r.src] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 60  # one document


def test_repeated_rows_meet_the_targets_of_their_sources(make_docs):
    """Many rows without an id, over three sources: what is delivered is what the mix takes."""
    rng = random.Random(8)
    made = [(None if i % 3 else i % 20, prose(i % 130, rng.choice([4, 20, 90])), "abc"[i % 7 % 3]) for i in range(450)]
    docs = make_docs(*made)
    words = lambda t: len((t or "").split())
    want, got = {}, {}
    for r in mixing.mix(docs, leaf=60, fan=3).collect():
        want[r.src] = want.get(r.src, 0) + r.taken
        assert r.taken <= 2 * r.size
    for r in mixing.repeat(docs, leaf=60, fan=3).collect():
        got[r.source] = got.get(r.source, 0) + words(r.text)
    assert got == want
    sizes = {s: sum(words(t) for _, t, x in made if x == s) for s in "abc"}
    assert all(abs(got[s] - t) <= 90 for s, t in targets(sizes).items())


def test_layout_does_not_matter(make_docs):
    docs = make_docs(*rows(120))
    ways = [mixing.mix(d, leaf=30, fan=2).select("doc_id", "size", "taken").collect() for d in (docs, docs.repartition(7), docs.coalesce(1))]
    assert len({tuple(sorted(map(str, w))) for w in ways}) == 1


def test_rounding_keeps_words_and_is_fair():
    rng = random.Random(1)
    total = 0.0
    for k in range(300):
        ids = [k * 100 + i for i in range(20)]
        sizes = sorted((rng.randint(1, 50) for _ in ids), reverse=True)
        after, held = mixing.round_pairs(ids, sizes, [0.3] * 20)
        assert sum(p * w for p, w in zip(after, sizes)) == pytest.approx(0.3 * sum(sizes))
        assert all(p in (0.0, 1.0) for j, p in enumerate(after) if j != held)
        total += after[0]
    assert 0.2 < total / 300 < 0.4  # the longest document is taken as often as it should


def test_repeated_documents_and_no_rows(make_docs):
    docs = make_docs(*rows(60))
    out = mixing.repeat(docs)
    assert out.columns == docs.columns
    taken = {r.doc_id: r.n for r in mixing.mix(docs).groupBy("doc_id").agg(F.sum("copies").alias("n")).collect()}
    got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert {i: n for i, n in taken.items() if n} == got
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.repeat(docs.limit(0)).count() == 0


def test_copies_are_merged_with_documents_of_any_number(make_docs):
    """The plan does not change from a broadcast of the counts to a shuffle as the documents grow."""
    plan = plan_text(mixing.repeat(make_docs(*rows()), leaf=60, fan=3))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan.split("SortMergeJoin")[0]
