from __future__ import annotations

import hashlib

from odd_rows import ODD, prose
from pyspark.sql import functions as F

from meterline.llm import exact_dedup


def expected(rows):
    out = []
    for i, t in rows:
        same = [j for j, u in rows if (u or "") == (t or "")]
        ids = [j for j in same if j is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(same), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_odd_rows_and_a_large_group(make_docs):
    rows = ODD + [(100 + i, "copy") for i in range(300)] + [(1000 + i, prose(i, 5)) for i in range(50)]
    assert found(exact_dedup.mark_copies(make_docs(*rows))) == expected(rows)


def test_texts_of_one_digest_stay_apart(make_docs):
    rows = ODD + [(100 + i, f"text {i % 7}") for i in range(60)]
    same = exact_dedup.mark_copies(make_docs(*rows), digest=lambda t: F.length(t).cast("string"), salts=3)
    assert found(same) == expected(rows)


def test_no_rows(make_docs):
    df = make_docs(*ODD).limit(0)
    assert exact_dedup.mark_copies(df).count() == 0


def test_plan_is_native(spark, small):
    from compare import plan_text

    plan = plan_text(exact_dedup.mark_copies(spark.read.parquet(f"{small}/documents.parquet")))
    assert "Python" not in plan and "Cartesian" not in plan
