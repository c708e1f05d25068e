"""Alignment against token by token brute force, and the query by its contract."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from odd_rows import ODD, prose
from tokenizers import Tokenizer

from meterline.llm import align, queries


@pytest.fixture(scope="module")
def tools():
    byte = Tokenizer.from_file(public_tokenizers.path(align.BYTE_VOCABULARY))
    byte.encode_special_tokens = True
    return byte, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(align.PIECE_VOCABULARY))


def plain_groups(text: str | None, tools) -> list[tuple[list[int], list[int]]]:
    """Groups by walking over the bytes, from the libraries' own ids."""
    if not text:
        return []
    byte, piece = tools
    letters = align.byte_letters()
    a = [(i, bytes(letters[c] for c in byte.id_to_token(i))) for i in byte.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(piece.id_to_piece(i)[3:5], 16)]) if piece.is_byte(i) else piece.id_to_piece(i).replace("▁", " ").encode()) for i in piece.encode(text)]
    whole = (" " + text).encode()
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return []
    out, i, j = [], 0, 0
    while i < len(a):
        left, right, n, m = [], [], 0, 0
        while not left or n != m:
            if n <= m:
                left.append(a[i][0])
                n, i = n + len(a[i][1]), i + 1
            else:
                right.append(b[j][0])
                m, j = m + len(b[j][1]), j + 1
        out.append((left, right))
    return out


def expected(rows, tools) -> list[tuple]:
    grouped = [plain_groups(t, tools) for _, t in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in grouped]
    held = Counter(p for each in links for p in each)
    best: dict[int, int] = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for (doc_id, _), g, each in zip(rows, grouped, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append(
            (
                doc_id, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(each.values()),
                sum(n for (x, y), n in each.items() if held[x, y] == best[x]), sum(n * held[p] for p, n in each.items()), text,
            )
        )
    return out


def ordered(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[7]))


def test_odd_texts(spark, make_docs, tools):
    rows = [
        *ODD, (20, "hello  world"), (21, " x "), (22, "a\nb\n\n c"), (23, "▁q stands for a blank"), (24, "<|endoftext|> and <s> </s> <0x41>"),
        (25, "naïve café Ünïcödé straße"), (26, "a　b\xa0c\x00d"), (27, "it's we'll 'tis 1234567890 --- !!! ..."), (28, "x" * 500), (29, "\t\ttabs\tand blanks \t "),
        (30, "é combined ​"), (31, " "), (32, "漢字かな交じり文 한국어 عربى"), (33, "🙂🙃 👩‍👩‍👧‍👦"), (34, "same words same words"), (34, "same words same words"),
    ]
    got = ordered(align.align(make_docs(*rows)).collect())
    assert got == ordered(expected(rows, tools))
    assert sum(r[1] for r in got) > 40_000 and sum(1 for r in got if r[1] == 0) >= 4


def test_digest_blocks_and_no_rows(spark, make_docs, tools, monkeypatch):
    rows = [(i, prose(i, 30 + i)) for i in range(60)]
    want = [(*r[:7], hashlib.sha256(r[7].encode()).hexdigest()) for r in expected(rows, tools)]
    got = align.align(make_docs(*rows).repartition(5), digest=True)
    assert ordered(got.collect()) == ordered(want)
    assert align.align(make_docs((1, "a")).limit(0)).count() == 0
    # Blocks of few links, within one process.
    tool, pieces = align.aligner(public_tokenizers.path(align.BYTE_VOCABULARY), public_tokenizers.path(align.PIECE_VOCABULARY)), []
    block = align.Block()
    for at in range(0, 60, 7):
        block.add([i for i, _ in rows[at : at + 7]], [t for _, t in rows[at : at + 7]], tool, digest=False)
        pieces += tool.align([t for _, t in rows[at : at + 7]])
    row = next(block.row(3).itertuples())
    assert row.docs == 60 and align._unpacked(row.entries).sum() == len(align._unpacked(row.times)) == sum(len(a.entries()[0]) for _, a in pieces)


def test_shared_cuts_of_random_ends():
    rng = random.Random(4)
    for _ in range(300):
        a_ends, b_ends, a_bounds, b_bounds, base = [], [], [0], [0], 0
        for _ in range(rng.randint(1, 5)):
            size = rng.randint(1, 60)
            for ends, bounds in ((a_ends, a_bounds), (b_ends, b_bounds)):
                ends += sorted({*rng.sample(range(1, size + 1), rng.randint(0, size)), size})
                ends[bounds[-1] :] = [base + e for e in ends[bounds[-1] :]]
                bounds.append(len(ends))
            base += size
        a, b = np.array(a_ends), np.array(b_ends)
        a_cut, b_cut = align.shared_cuts(a, b, np.array(a_bounds), np.array(b_bounds))
        assert a_cut.tolist() == np.isin(a, b).tolist() and b_cut.tolist() == np.isin(b, a).tolist()


def test_query_by_its_contract(spark, small, tools):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    want = [(*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[1] else "") for r in expected(rows, tools)]
    got = queries.registered()["op12_align"](spark, small)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert ordered(got.collect()) == ordered(want)
