from __future__ import annotations

import pytest
from compare import connect, differences

import corpus_pipeline
from meterline.llm import decontaminate, mixing, queries, simhash, token_files, toxicity


@pytest.mark.parametrize("name", sorted(queries.statements()))
def test_query_agrees_with_sql(spark, small, name):
    df = queries.registered()[name](spark, small)
    assert differences(df, connect(small), queries.statements()[name]) == []


def test_one_query_for_each_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.registered())
    assert numbers == list(range(1, 14))


def test_stages_take_effect(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    bench = spark.read.parquet(f"{small}/benchmark.parquet")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(stage(spark, kept[-1], small).cache())
        assert kept[-1].columns == docs.columns
    ids = [sorted(r.doc_id for r in k.select("doc_id").collect()) for k in kept]
    bad = {r.doc_id for r in toxicity.classify(kept[0], labels).collect() if r.predicted}
    assert ids[1] == [i for i in ids[0] if i not in bad]
    groups = simhash.components(kept[1]).collect()
    assert ids[2] == sorted({r.component_id for r in groups})
    dirty = {r.doc_id for r in decontaminate.contamination(kept[2], bench).collect() if r.contaminated}
    assert ids[3] == [i for i in ids[2] if i not in dirty]
    assert ids[4] == sorted(r.doc_id for r in mixing.mix(kept[3]).collect() for _ in range(r.copies))
    last = corpus_pipeline.STAGES[-1][1](spark, kept[-1], small)
    row = lambda df: sorted(tuple(r) for r in df.collect())
    assert row(last) == row(token_files.round_trip(kept[-1])) and last.count() == len(ids[4])


def test_run_and_no_rows(spark, small, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{small}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
