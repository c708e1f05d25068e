from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from meterline import scratch
from meterline.sources import contract, readers, writers


def names(df):
    return sorted(df.columns)


@pytest.fixture
def months(spark, tmp_path):
    """Three monthly files: int and long codes, a capital letter, an extra column, doubles."""
    paths = [str(tmp_path / f"yellow_2023-0{i}.parquet") for i in (1, 2, 3)]
    base = spark.range(4).select(F.col("id").alias("VendorID"), F.lit(1.5).alias("fare_amount"))
    base.select(F.col("VendorID").cast("int"), "fare_amount", F.lit(0.0).alias("airport_fee")).write.parquet(paths[0])
    base.select("VendorID", "fare_amount", F.lit(1.25).alias("Airport_fee")).write.parquet(paths[1])
    base.select(
        F.col("VendorID").cast("double"), "fare_amount", F.lit(1.25).alias("Airport_fee"), F.lit("x").alias("more")
    ).write.parquet(paths[2])
    return paths


def test_months_become_one_table(spark, months):
    table, report = readers.read_months(spark, months)
    assert table.columns == ["airport_fee", "fare_amount", "source_month", "vendorid"]
    assert dict(table.dtypes)["vendorid"] == "bigint"
    got = {r.source_month: (r["count"], r["total"]) for r in
           table.groupBy("source_month").agg(F.count("*").alias("count"), F.sum("vendorid").alias("total")).collect()}
    assert got == {"2023-01": (4, 6), "2023-02": (4, 6), "2023-03": (4, 6)}
    assert report.dropped == {months[2]: ("more",)}


def test_files_of_one_schema_share_a_scan(spark, tmp_path):
    paths = [str(tmp_path / f"t_2023-{i:02d}.parquet") for i in range(1, 7)]
    for p in paths:
        spark.range(2).select(F.col("id").alias("vendorid")).write.parquet(p)
    table, _ = readers.read_months(spark, paths)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert table.select("source_month").distinct().count() == 6


def test_names_that_differ_by_case_are_refused():
    with pytest.raises(ValueError, match="differ only by case"):
        contract.lower_names(["Fee", "fee"])


def test_bad_values_become_null(spark):
    df = spark.createDataFrame([("7",), ("x",)], "VendorID string")
    assert [r.vendorid for r in contract.normalize(df).collect()] == [7, None]


def test_lookup(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text("LocationID,Borough,Zone,service_zone\n1,EWR,Newark Airport,EWR\n")
    zones = readers.read_lookup(spark, str(path))
    assert zones.columns == ["locationid", "borough", "zone", "service_zone"]
    assert zones.first().locationid == 1
    inferred = readers.read_lookup(spark, str(path), schema=None)
    assert dict(inferred.dtypes)["locationid"] == "int"
    assert readers.read_lookup(spark, str(tmp_path / "none.csv")) is None


def month_rows(spark, month, n):
    return spark.range(n).select(F.col("id"), F.lit(month).alias("source_month"))


def test_partitioned_write_and_read(spark, tmp_path):
    path = str(tmp_path / "clean")
    both = month_rows(spark, "2023-01", 3).unionByName(month_rows(spark, "2023-02", 5))
    assert writers.write_partitioned(both, path)
    counts = [tuple(r) for r in writers.count_partitions(spark, path).collect()]
    assert counts == [("2023-01", 3), ("2023-02", 5)]
    one = readers.read_table(spark, path, "2023-02")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source_month" in plan
    assert one.count() == readers.read_partition(spark, path, "2023-02").count() == 5
    assert dict(readers.read_partition(spark, path, "2023-02").dtypes)["source_month"] == "string"


def test_what_happens_to_a_present_table(spark, tmp_path):
    path = str(tmp_path / "clean")
    writers.write_partitioned(month_rows(spark, "2023-01", 3), path)
    assert not writers.write_partitioned(month_rows(spark, "2023-01", 9), path, if_present="skip")
    writers.write_partitioned(month_rows(spark, "2023-02", 4), path, if_present="overwrite_partitions")
    writers.write_partitioned(month_rows(spark, "2023-01", 2), path, if_present="overwrite_partitions")
    counts = {r.source_month: r.row_count for r in writers.count_partitions(spark, path).collect()}
    assert counts == {"2023-01": 2, "2023-02": 4}
    writers.write_partitioned(month_rows(spark, "2023-03", 1), path)
    assert writers.count_partitions(spark, path).count() == 1


def test_half_written_table_is_not_skipped(spark, tmp_path):
    path = str(tmp_path / "clean")
    writers.write_partitioned(month_rows(spark, "2023-01", 3), path)
    (tmp_path / "clean" / "_SUCCESS").unlink()
    assert not scratch.is_complete(spark, path)
    assert writers.write_partitioned(month_rows(spark, "2023-01", 9), path, if_present="skip")
    assert spark.read.parquet(path).count() == 9


def test_one_big_month_is_written_by_several_tasks(spark, tmp_path):
    path = tmp_path / "clean"
    rows = spark.range(0, 400_000, 1, 8).select(
        F.col("id"), F.xxhash64("id").alias("a"), F.xxhash64("id", F.lit(1)).alias("b"), F.lit("2023-01").alias("source_month")
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1MB")
    try:
        writers.write_partitioned(rows, str(path))
    finally:
        spark.conf.set(key, before)
    assert len(list(path.glob("source_month=2023-01/*.parquet"))) > 3


def test_report_falls_back_to_csv_and_says_why(spark, tmp_path):
    report = spark.createDataFrame([("a", 1.5)], "name string, value double")
    sent = writers.deliver_report(
        report, "report", "jdbc:nothing://nowhere/db", {"driver": "no.such.Driver"}, str(tmp_path / "csv")
    )
    assert sent.kind == "csv" and sent.problem
    files = list((tmp_path / "csv").glob("*.csv"))
    assert len(files) == 1
    assert files[0].read_text().splitlines() == ["name,value", "a,1.5"]


def test_requests_table(spark):
    table = readers.requests_table(spark, [{"payment_type": 2, "trip_distance": 1.0}])
    assert table.first().payment_type == 2 and table.first().fare_amount is None
    with pytest.raises(ValueError, match="unknown request fields"):
        readers.requests_table(spark, [{"payment": 2}])


def test_scratch_paths_lie_in_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch.fresh_path(spark, "t"), scratch.fresh_path(spark, "t")
    assert one.startswith(folder) and one != two


def test_files_of_one_folder_may_differ(spark, tmp_path):
    path = str(tmp_path / "t_2023-01.parquet")
    spark.range(3).select(F.col("id").alias("vendorid"), F.lit(1.5).alias("tolls_amount")).coalesce(1).write.parquet(path)
    spark.range(5).select(F.col("id").alias("vendorid")).coalesce(1).write.mode("append").parquet(path)
    table, report = readers.read_months(spark, [path])
    assert table.columns == ["source_month", "vendorid"] and table.count() == 8
    assert list(report.dropped.values()) == [("tolls_amount",)]


def test_a_path_without_a_month_is_an_error(spark, tmp_path):
    path = str(tmp_path / "trips.parquet")
    spark.range(2).write.parquet(path)
    with pytest.raises(ValueError, match="no month"):
        readers.read_months(spark, [path])


def test_months_as_folders(spark, tmp_path):
    path = str(tmp_path / "2023-04")
    spark.range(2).write.parquet(path)
    table, _ = readers.read_months(spark, [path])
    assert [r.source_month for r in table.collect()] == ["2023-04"] * 2


def test_capitals_in_a_session_that_tells_them_apart(spark, months):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        table, _ = readers.read_months(spark, months)
        assert table.filter("vendorid IS NULL OR airport_fee IS NULL").count() == 0 and table.count() == 12
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_an_error_without_text_still_falls_back(spark, tmp_path, monkeypatch):
    def fail(*_, **__):
        raise RuntimeError

    monkeypatch.setattr(writers, "write_jdbc", fail)
    sent = writers.deliver_report(spark.range(2).toDF("n"), "t", "jdbc:x", {}, str(tmp_path / "t"))
    assert (sent.kind, sent.told()) == ("csv", "csv fallback: RuntimeError")


def test_bad_lines_of_a_lookup_are_rejected_with_reasons(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text('LocationID,Borough,Zone,service_zone\n1,B,"a, b",x\ntwo,B,Z,x\n3,B,Z\n4,B,Z,x,y\n5,,Z,\n')
    good, bad = readers.read_lookup_checked(spark, str(path))
    assert sorted(map(tuple, good.collect()), key=str) == [(1, "B", "a, b", "x"), (5, None, "Z", None)]
    got = sorted((r.line, r.reason) for r in bad.collect())
    assert got == [("3,B,Z", "3 fields instead of 4"), ("4,B,Z,x,y", "5 fields instead of 4"), ("two,B,Z,x", "locationid is no bigint")]
    assert bad.first().file.endswith("zones.csv") and readers.read_lookup_checked(spark, str(tmp_path / "none.csv")) is None
