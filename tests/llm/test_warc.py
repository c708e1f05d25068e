from __future__ import annotations

import base64
import hashlib

import pytest

from meterline.llm import warc

INNER = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:777>\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
ROWS = [
    (1, "u", "x" * 5000), (2, "u\r\n x", INNER * 3), (3, None, None), (4, "u", ""), (5, "u", "WARC/1.1\r\n"),
    (6, "u", "a WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 99999999\r\n\r\n b"),
    (7, "é", "é" * 3000 + "\r\n\r\nWARC/1.1\r\n" + INNER + "é"), (8, "u", "x" * 5000), (None, "u", "x" * 5000), (9, "u", INNER * 3),
    *[(i, "v", f"body {i} WARC/1.1\r\n" + "y" * (i * 37 % 977)) for i in range(100, 130)],
]


def expected(rows, least=0):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        again = len(raw) >= least and first[h or ""] != i
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((i, len(raw), digest, "revisit" if again else "response", first[h or ""] if again else None, True))
    return sorted(out, key=str)


@pytest.mark.parametrize(("codec", "split"), [("gzip", "128m"), ("none", "6k")])
def test_round_trip_with_magic_in_payloads(spark, codec, split):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").repartition(2)
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]
    try:
        spark.conf.set(keys[0], split)
        spark.conf.set(keys[1], "1k")
        got = warc.round_trip(df, codec=codec).collect()
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)
    assert sorted((tuple(r) for r in got), key=str) == expected(ROWS)


def test_short_payloads_are_all_responses(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]
    got = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string"), least_bytes=3).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows, 3)


def test_other_columns_and_no_rows(spark):
    df = spark.createDataFrame([(1, "u", "a", "z", "z", 3)], "page_id long, url string, html string, digest string, body string, salt int")
    assert warc.round_trip(df).count() == 1
    assert warc.round_trip(df.limit(0)).count() == 0


def test_base32_agrees_with_the_library(spark):
    text = "grüße"
    got = spark.sql(f"SELECT '{text}' AS t").select(warc.sha1_base32(warc.F.col("t"))).first()[0]
    assert got == base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def damaged_copies(spark, tmp_path, change) -> str:
    """A folder with one plain archive of ten records, as it is, and one changed."""
    df = spark.createDataFrame([(i, "u", f"payload {i} " + "z" * 500) for i in range(10)], "page_id long, url string, html string")
    warc.write_archives(df.coalesce(1), str(tmp_path / "made"), codec="none")
    (file,) = [f for f in (tmp_path / "made").iterdir() if f.name.startswith("part-")]
    folder = tmp_path / "read"
    folder.mkdir()
    raw = file.read_bytes()
    (folder / "a.warc").write_bytes(raw)
    (folder / "b.warc").write_bytes(change(raw))
    return str(folder)


@pytest.mark.parametrize(
    ("change", "whole"),
    [
        (lambda raw: raw[:-30], 9),  # cut within the last record
        (lambda raw: raw[: len(raw) // 2 + 100], 5),  # within the head of the sixth
        (lambda raw: raw.replace(b"payload 4 z", b"payload 4 zz"), None),  # one byte more than the head says
        (lambda raw: b"x" + raw, 0),
        (lambda raw: raw + b"junk behind the last record", 10),
    ],
)
def test_damaged_archives_are_told(spark, tmp_path, change, whole):
    folder = damaged_copies(spark, tmp_path, change)
    with pytest.raises(warc.DamagedArchive, match="b.warc") as told:
        warc.read_archives(spark, folder)
    assert len(told.value.places) == 1 and told.value.places[0][0].endswith("b.warc")
    got = warc.read_archives(spark, folder, damaged="skip").collect()
    assert (len(got) == 10 + whole if whole is not None else 10 < len(got) <= 20) and all(r.digest_holds and r.page_id is not None for r in got)


def test_a_changed_payload_fails_its_digest(spark, tmp_path):
    folder = damaged_copies(spark, tmp_path, lambda raw: raw.replace(b"payload 4 z", b"payload 4 y"))
    got = warc.read_archives(spark, folder).collect()
    assert len(got) == 20 and [r.page_id for r in got if not r.digest_holds] == [4]
