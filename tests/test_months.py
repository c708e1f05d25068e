"""The store of months: only changed months are made, readers see whole updates, content decides."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from meterline import scratch
from meterline.operators.content import content, content_by
from meterline.operators.reports import summary_from, trip_summary
from meterline.plans import jobs
from meterline.plans.bindings import ANY_PERIOD, trips


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def raw(spark, small):
    return trips(spark, small).filter("source_month < '1995-07'")


@pytest.fixture
def store(spark, tmp_path):
    return jobs.month_store(spark, str(tmp_path / "store"), ANY_PERIOD)


def test_content_tells_tables_apart(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, 0.5), (2, None, 0.5)], "n int, s string, x double")
    same = content(df.repartition(3).select("x", "n", "s"))
    assert content(df) == same
    others = [
        df.distinct(), df.limit(2), df.withColumn("s", F.col("s").substr(1, 0)), df.withColumn("x", F.coalesce("x", F.lit(0.0))),
        spark.createDataFrame([(1, None, None), (2, "a", 0.5), (2, None, 0.5)], "n int, s string, x double"),
    ]
    assert all(content(o) != same for o in others)
    odd = spark.createDataFrame([({"a": 1, "b": 2},), ({"b": 2, "a": 1},)], "m map<string,int>")
    assert content_by(odd.withColumn("k", F.lit(None).cast("string")), "k").first().rows == 2
    assert content(df.limit(0))["rows"] == 0


def test_only_changed_months_are_made(spark, store, raw):
    first = {r.source_month: r.action for r in store.update(raw.filter("source_month < '1995-05'")).collect()}
    assert set(first.values()) == {"added"} and len(first) == 4
    versions = {m.month: m.version for m in store.manifest()[1]}
    grown = raw.filter("NOT (source_month = '1995-02' AND l_orderkey % 2 = 0)")  # fewer rows of one month, two new months
    told = {r.source_month: r.action for r in store.update(grown).collect()}
    assert told == {"1995-01": "kept", "1995-02": "replaced", "1995-03": "kept", "1995-04": "kept", "1995-05": "added", "1995-06": "added"}
    now = {m.month: m.version for m in store.manifest()[1]}
    assert {m for m in versions if now[m] == versions[m]} == {"1995-01", "1995-03", "1995-04"}
    want = jobs.transform(grown, ANY_PERIOD)
    assert store.table().schema.names == want.schema.names and rows(store.table()) == rows(want)
    assert summary_from(store.summary_sums()).collect() == trip_summary(want).collect()
    number = store.manifest()[0]
    assert {r.action for r in store.update(grown.repartition(5)).collect()} == {"kept"} and store.manifest()[0] == number
    assert [r.action for r in replace(store, settings="others").update(raw.filter("source_month = '1995-03'")).collect() if r.source_month == "1995-03"] == ["replaced"]


def test_months_that_are_gone_and_months_without_valid_rows(spark, store, raw, make_trips):
    store.update(raw.filter("source_month < '1995-03'"))
    assert {r.source_month: r.action for r in store.update(raw.filter("source_month = '1995-02'"), whole=True).collect()} == {
        "1995-01": "removed", "1995-02": "kept"
    }
    assert {r.source_month for r in store.table().select("source_month").distinct().collect()} == {"1995-02"}
    bad = raw.filter("source_month = '1995-02'").withColumn("fare_amount", F.lit(-1.0))
    assert [tuple(r)[:2] + (r.row_count,) for r in store.update(bad).collect()] == [("1995-02", "replaced", 0)]
    assert store.table().count() == 0 and summary_from(store.summary_sums()).count() == 0
    assert store.update(raw.limit(0)).collect()[0].action == "kept"


def test_months_that_are_not_known(spark, store, raw):
    some = raw.filter("source_month = '1995-01'").withColumn("source_month", F.when(F.col("l_orderkey") % 2 == 0, F.col("source_month")))
    store.update(some)
    want = jobs.transform(some, ANY_PERIOD)
    assert rows(store.table()) == rows(want) and rows(summary_from(store.summary_sums())) == rows(trip_summary(want))


def test_a_crash_leaves_the_table_as_it_was(spark, store, raw, monkeypatch):
    store.update(raw.filter("source_month = '1995-01'"))
    before, number = rows(store.table()), store.manifest()[0]

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(scratch, "write_new", crash)
        with pytest.raises(OSError, match="lost"):
            store.update(raw)
    assert rows(store.table()) == before and store.manifest()[0] == number and len(store.unused()) == 1
    # A manifest cut short is as good as none, and its number is not used again.
    scratch.write_new(spark, f"{store.root}/manifests/manifest-{number + 1:09d}.json", '[{"month": "1995')
    assert store.manifest()[0] == number and rows(store.table()) == before
    store.update(raw)
    assert store.manifest()[0] == number + 2 and rows(store.table()) == rows(jobs.transform(raw, ANY_PERIOD))


def test_two_writers_cannot_both_commit(spark, store, raw):
    store.update(raw.filter("source_month = '1995-01'"))
    number, months = store.manifest()
    store._commit(number, months)
    with pytest.raises(RuntimeError, match="meanwhile"):
        store._commit(number, months)


def test_a_store_without_months(store):
    with pytest.raises(ValueError, match="no months"):
        store.table()
