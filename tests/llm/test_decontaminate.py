from __future__ import annotations

import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_rows import ODD, prose

import corpus_pipeline
from compare import connect, differences
from meterline.llm import decontaminate as dc
from meterline.llm import queries

LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(docs, items, window=13):
    phrases = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            phrases.setdefault(tuple(w[k : k + window]), set()).add(str(i))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for p, names in phrases.items():
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k : k + len(p)]) == p:
                    hit |= set(range(k, k + len(p)))
                    found |= names
        out.append((i, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=12), min_size=1, max_size=8))
def test_index_finds_every_sequence(docs):
    coded = [[w.encode() for w in d] for d in docs]
    index, starts = dc.FMIndex.of(coded)
    index = dc.FMIndex.from_bytes(index.to_bytes())
    for size in (1, 2, 3):
        every = {tuple(d[k : k + size]) for d in coded for k in range(len(d) - size + 1)} | {(b"a",) * size}
        for p in every:
            low, high = index.ranges(np.array([[index.number.get(w, 0) for w in p]]))
            got = sorted(index.places(np.arange(low[0], high[0])).tolist())
            want = sorted(int(s) + k for s, d in zip(starts, coded) for k in range(len(d) - size + 1) if tuple(d[k : k + size]) == p)
            assert got == want


def test_suffixes_are_in_order():
    symbols = np.array([1, 2, 1, 2, 1, 0, 1, 2, 1, 2, 1, 0, 0, 2, 2, 0])
    key = lambda i: [(s if s else -100 + j) for j, s in enumerate(symbols.tolist()) if j >= i][: symbols.tolist().index(0, i) - i + 1]
    assert dc.suffix_array(symbols).tolist() == sorted(range(len(symbols)), key=key)


ITEMS = [(1, prose(50, 40)), (2, "short item"), (3, None), (4, "..."), (11, prose(50, 40)), (5, "dup dup dup"), (6, prose(51, 13)), (None, "one")]
DOCS = ODD + [
    (20, prose(60, 30) + " " + prose(50, 40) + " " + prose(61, 300)), (21, "Short, ITEM! and short item"),
    (22, " ".join(prose(50, 40).split()[5:25]) + " " + prose(62, 20)), (23, " ".join(prose(50, 40).split()[:12])),
    (24, "dup " * 9), (25, prose(63, 2000) + " " + prose(51, 13)),
]


@pytest.mark.parametrize(("block", "shard"), [(dc.BLOCK, dc.SHARD), (7, 64)])
def test_against_all_windows(spark, make_docs, block, shard):
    bench = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, phrase string")
    got = dc.contamination(make_docs(*DOCS), bench, block=block, shard=shard).collect()
    want = plain(DOCS, ITEMS)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, sorted(map(str, r.items)), r.contaminated) for r in got), key=str) == want
    for r in got:
        spans = [(s["first"], s["stop"]) for s in r.spans or []]
        assert sum(b - a for a, b in spans) == r.n_hit and spans == sorted(spans)


def test_clean_documents_stay(spark, make_docs):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = dc.keep_clean(make_docs(*DOCS), bench)
    gone = {i for i, *_, bad in plain(DOCS, ITEMS) if bad}
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted(i or 0 for i, _ in DOCS if i not in gone)


def test_rows_are_judged_by_their_own_texts(spark, make_docs):
    """Several rows without an id and two texts under one id: only the dirty ones go."""
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    dirty = prose(70, 5) + " " + prose(50, 40)
    rows = [(None, prose(71, 30)), (None, dirty), (None, prose(72, 30)), (7, prose(73, 9)), (7, dirty), (8, prose(74, 9)), (8, prose(74, 9))]
    kept = dc.keep_clean(make_docs(*rows), bench)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(((i, t) for i, t in rows if t != dirty), key=str)


def test_items_without_an_id_are_searched(spark, make_docs, tmp_path):
    items = [*ITEMS, (None, prose(52, 20)), (7, prose(51, 13))]
    docs = [*DOCS, (30, prose(64, 20) + " " + prose(52, 20)), (31, "one " + prose(50, 40))]
    made = make_docs(*docs)
    made.write.parquet(str(tmp_path / "documents.parquet"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    want = plain(docs, items)
    got = dc.contamination(made, bench, block=7, shard=64).collect()
    told = sorted(((r.doc_id, r.n_words, r.n_hit, sorted(map(str, r.items)), r.contaminated) for r in got), key=str)
    assert told == want
    found = queries.op7_decontaminate(spark, str(tmp_path))
    assert {r.doc_id: (r.n_hit, r.n_items) for r in found.collect()}[30] == (20, 1)
    assert differences(found, connect(str(tmp_path)), queries.OP7_SQL) == []
    gone = {i for i, *_, bad in want if bad}
    kept = corpus_pipeline.clean(spark, made, str(tmp_path))
    assert {4, 5, 30, 31} <= gone and sorted(r.doc_id or 0 for r in kept.collect()) == sorted(i or 0 for i, _ in docs if i not in gone)


def test_cutting_spans():
    assert dc.without_spans("A b, c; d e!", [(1, 3)]) == "A ; d e!"
    assert dc.without_spans("a b c", [(0, 1), (2, 3)]) == " b "


def test_no_rows(spark, make_docs):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert dc.contamination(make_docs(*DOCS).limit(0), bench).count() == 0
    none = dc.contamination(make_docs(*DOCS), bench.limit(0)).collect()
    assert len(none) == len(DOCS) and not any(r.contaminated for r in none)
