from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_rows import ODD, prose
from tokenizers import Tokenizer

from meterline.llm import token_files
from meterline.llm.wavelet import WaveletMatrix

LOOSE = [(-5, "a  b \n c"), (-4, " lead and trail "), (-1, "x\n\n y <|endoftext|> z 's it's\t q  "), (-6, "\xa0 \x1c a 　b"), (-7, "one, two. one, <|")]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70_000), max_size=300))
def test_matrix_answers_like_the_list(values):
    symbols = np.array(values, dtype=np.int64)
    matrix = WaveletMatrix.from_bytes(WaveletMatrix.of(symbols).to_bytes())
    assert matrix.symbols().tolist() == values
    if not values:
        return
    found, _ = matrix.access(np.arange(len(values)))
    assert found.tolist() == values
    for v in {*values[:5], 3, 80_000}:
        assert matrix.count(np.array([v]))[0] == values.count(v)
        if v in values:
            assert matrix.occurrences(v).tolist() == [i for i, x in enumerate(values) if x == v]
    half = len(values) // 2
    assert matrix.rank(np.array(values), np.full(len(values), half)).tolist() == [values[:half].count(v) for v in values]


def test_long_matrix():
    symbols = np.random.default_rng(0).zipf(1.3, 100_000) % 50_000
    matrix = WaveletMatrix.of(symbols)
    assert (matrix.symbols() == symbols).all()
    assert matrix.occurrences(1).tolist() == np.flatnonzero(symbols == 1).tolist()


def test_files_hold_what_the_library_gives(spark, make_docs):
    tool = Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY))
    rows = ODD + LOOSE + [(100 + i, prose(i, 40)) for i in range(40)]
    got = token_files.round_trip(make_docs(*rows)).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    texts = dict(rows)
    start = 0
    for r in got:
        ids = tool.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_many_small_shards_and_lookup(spark, make_docs, tmp_path):
    rows = [(i, prose(i, 30)) for i in range(30)]
    path = str(tmp_path / "shards")
    token_files.write_shards(make_docs(*rows), path, shard=100)
    back = token_files.read_documents(spark, path).collect()
    tool = Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY))
    ids = {i: tool.encode(t, add_special_tokens=False).ids + [0] for i, t in rows}
    assert sorted((r.doc_id, r.n_tokens) for r in back) == [(i, len(ids[i])) for i, _ in rows]
    token = ids[3][2]
    assert sum(r.n for r in token_files.lookup(spark, path, token).collect()) == sum(x.count(token) for x in ids.values())


def test_memory_may_be_small(monkeypatch):
    monkeypatch.setattr(token_files, "MEMO", 10)
    path = public_tokenizers.path(token_files.VOCABULARY)
    tool, plain = token_files.Encoder(path), Tokenizer.from_file(path)
    texts = [prose(i, 50) for i in range(8)] + [t or "" for _, t in ODD + LOOSE]
    for _ in range(3):
        assert [x.tolist() for x in tool.encode(texts)] == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


def test_no_rows(make_docs):
    assert token_files.round_trip(make_docs(*ODD).limit(0)).count() == 0
