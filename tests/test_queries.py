from __future__ import annotations

import pytest
from compare import connect, differences, plan_text
from pyspark.sql import functions as F

import __spark_entry__ as contract

# Rows only, or minutes of training: run by the driver, not here.
LONG = {"cv_leaderboard", "cv_leaderboard_shape", "tuned_vs_baseline"}


@pytest.fixture(scope="module")
def db(small):
    return connect(small)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_statement_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(set(contract.oracle_sql()) - LONG))
def test_query_agrees_with_sql(spark, db, small, name):
    df = contract.queries()[name](spark, small)
    assert differences(df, db, contract.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql()) - LONG))
def test_query_runs(spark, small, name):
    assert contract.queries()[name](spark, small).count() > 0


@pytest.mark.parametrize("name", ["trip_summary", "rule_audit", "fare_histogram", "scored_responses", "class_distribution"])
def test_plans_stay_in_the_jvm_without_cartesian_products(spark, small, name):
    plan = plan_text(contract.queries()[name](spark, small))
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_dropped_columns_writes_by_many_tasks(spark, small, tmp_path, monkeypatch):
    from meterline.plans import catalog

    spark.read.parquet(f"{small}/orders.parquet").repartition(3).write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(catalog.scratch, "fresh_path", lambda spark, name: str(tmp_path / name))
    rows = sorted(tuple(r) for r in catalog.dropped_columns(spark, str(tmp_path)).collect())
    assert len(list((tmp_path / "folders/orders_1995-01.parquet").glob("part-*"))) > 1
    monkeypatch.undo()
    assert rows == sorted(tuple(r) for r in catalog.dropped_columns(spark, small).collect())


def test_trips_come_in_as_many_tasks_as_their_number_asks_for(spark, small, monkeypatch):
    """Tasks hold a bounded number of trips however well the files are compressed, and copies are found where they lie."""
    from meterline.operators import cleaning
    from meterline.plans import bindings

    plain = bindings.trips(spark, small)
    monkeypatch.setattr(bindings, "LINES_A_TASK", 200)
    laid = bindings.trips(spark, small)
    tasks = -(-laid.count() // 200)
    sizes = [r["count"] for r in laid.groupBy(F.spark_partition_id()).count().collect()]
    assert tasks > bindings.LEAST_TASKS and len(sizes) > tasks // 2 and max(sizes) < 600
    assert laid.exceptAll(plain).count() == 0 == plain.exceptAll(laid).count()
    twice = cleaning.clean_rows(laid.unionByName(laid), bindings.ANY_PERIOD)
    assert plan_text(twice).count("hashpartitioning(") <= 2  # one a branch of the union
    assert twice.count() == cleaning.clean_rows(plain, bindings.ANY_PERIOD).count()
