from __future__ import annotations

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Observation
from pyspark.sql import functions as F

from meterline import scratch
from meterline.functions import vectors
from meterline.ml import features, models
from meterline.operators import cleaning, evaluation, scoring
from meterline.plans import jobs
from meterline.plans.bindings import ANY_PERIOD, TRIP_KEYS, trips
from meterline.sources import readers, writers


@pytest.fixture(scope="module")
def clean(spark, small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ml") / "clean")
    writers.write_partitioned(cleaning.clean_rows(trips(spark, small), ANY_PERIOD), path)
    return readers.read_table(spark, path)


@pytest.fixture(scope="module")
def prepared(clean, tmp_path_factory):
    return features.prepare(clean, str(tmp_path_factory.mktemp("prep")), keys=TRIP_KEYS)


@pytest.fixture(scope="module")
def forest(prepared):
    return models.train_classifier(prepared.train, models.ForestSettings(trees=10, depth=5))


def test_vector_positions_have_their_own_names(prepared, clean):
    names = features.slot_names(prepared.stages, clean)
    assert len(names) == len(set(names)) == 26
    assert names[:3] == ["vendorid", "passenger_count", "trip_distance"]
    assert sum(n.startswith("time_of_day_enc_") for n in names) == 4
    assert sum(n.startswith("store_and_fwd_flag_enc_") for n in names) == 2
    assert len(prepared.train.first().features) == 26


def test_a_fresh_model_scores_in_a_session_that_observed_a_table(spark, prepared, forest):
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("rows")).collect()
    assert seen.get == {"rows": 3} and forest.hasSummary
    assert scoring.score_by_model(prepared.test, forest).count() == prepared.test.count()
    figures = models.classifier_metrics(scoring.score_by_model(prepared.test, forest))
    assert {r.metric for r in figures.collect()} == {"auc", "accuracy", "precision", "recall", "f1"}


def test_vectors_are_written_in_equal_shares(clean, tmp_path, monkeypatch):
    """One file that holds everything before: training has a task for every core all the same."""
    monkeypatch.setattr(features, "LEAST_ROWS", 100)
    lumped = clean.coalesce(1)
    ready = features.prepare(lumped, str(tmp_path / "prep"), keys=TRIP_KEYS)
    sizes = [len(part) for part in ready.train.select(features.LABEL).rdd.glom().collect()]
    assert len(sizes) == clean.sparkSession.sparkContext.defaultParallelism and max(sizes) < 1.25 * min(sizes)
    assert sum(sizes) + ready.test.count() == features.complete_inputs(clean).count()


def test_shares_of_many_and_few_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    shares = lambda count: features.evenly(spark.range(3), count).rdd.getNumPartitions()
    assert [shares(n) for n in (0, 25_000, 10_000_000, cores * features.MOST_ROWS + 1)] == [1, 2, cores, 2 * cores]


def test_similar_vectors_are_written_together(spark, clean, tmp_path, monkeypatch):
    """In each share, part by part; the order outlives the write of the parts."""
    monkeypatch.setattr(features, "LEAST_ROWS", 100)
    ready = features.prepare(clean, str(tmp_path / "prep"), keys=TRIP_KEYS, written=True)
    names = [*ready.train.inputFiles(), *ready.test.inputFiles()]
    assert len(names) > 2
    for name in names:
        signs = [tuple(x > 0 for x in r.features) for r in spark.read.parquet(name).collect()]
        assert signs == sorted(signs) and len(set(signs)) > 1


def test_likeness_of_odd_vectors(spark):
    """Long vectors count by their first positions; not-a-number sorts as large, as it does in Spark."""
    from pyspark.ml.linalg import Vectors

    rows = [[1.0, -1.0], [0.0, 2.0], [float("nan"), 0.0], [], [1.0] * 100, [-1.0] * 99 + [1.0]]
    frame = spark.createDataFrame([(i, Vectors.dense(r)) for i, r in enumerate(rows)], ["id", "features"])
    found = {r.id: r.bits for r in frame.select("id", vectors.likeness("features").alias("bits")).collect()}
    assert found == {0: 2, 1: 1, 2: 2, 3: 0, 4: (1 << 62) - 1, 5: 0}


def test_rows_are_dealt_without_sorting_and_none_is_lost(spark, tmp_path):
    """Sorting before the shares, as before, goes to disk where a task reads millions of rows."""
    path = str(tmp_path / "rows")
    spark.range(0, 200_000, 1, 3).withColumn("text", F.lit("the same")).write.parquet(path)
    rows = spark.read.parquet(path)
    shared = features.evenly(rows, 200_000)
    assert "RoundRobinPartitioning" not in shared._jdf.queryExecution().executedPlan().toString()
    sizes = [len(part) for part in shared.rdd.glom().collect()]
    assert len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) - min(sizes) <= rows.rdd.getNumPartitions()
    assert shared.columns == rows.columns and shared.agg(F.sum("id")).first()[0] == 199_999 * 100_000


def test_a_written_table_is_not_written_again(spark, clean, prepared, tmp_path):
    ready = features.prepare(clean, str(tmp_path / "prep"), keys=TRIP_KEYS, written=True)
    assert not scratch.path_exists(spark, str(tmp_path / "prep" / "rows"))
    near = lambda rows: rows.select(features.LABEL, F.transform(vector_to_array("features"), lambda x: F.round(x, 6)))
    for mine, other in ((ready.train, prepared.train), (ready.test, prepared.test)):
        assert mine.count() == other.count() and near(mine).exceptAll(near(other)).isEmpty()
    assert ready.classes.exceptAll(prepared.classes).isEmpty()


def trees_of(model):
    return model.toDebugString.split("\n", 1)[1]


def test_remembered_nodes_give_the_same_forest(spark, prepared, forest, monkeypatch):
    """Each level goes on from the nodes of the one before where they fit into memory, and walks where not."""
    assert forest.getCacheNodeIds()
    monkeypatch.setattr(models, "executor_memory", lambda spark: 0)
    walked = models.train_classifier(prepared.train, models.ForestSettings(trees=10, depth=5))
    assert not walked.getCacheNodeIds() and trees_of(walked) == trees_of(forest)


def test_tuning_remembers_nodes_and_finds_the_same(spark, prepared, monkeypatch):
    grid = models.TuningGrid(trees=(2, 3), depths=(2,), least_rows=(1,), folds=2, sample=0.5)
    found = models.tune_classifier(prepared.train, grid)
    assert found.bestModel.getCacheNodeIds()
    monkeypatch.setattr(models, "executor_memory", lambda spark: 0)
    walked = models.tune_classifier(prepared.train, grid)
    assert found.avgMetrics == walked.avgMetrics and trees_of(found.bestModel) == trees_of(walked.bestModel)


def test_memory_bounds_what_is_remembered(spark):
    memory = scratch.executor_memory(spark)
    rows = memory // (models.ROW_BYTES + 50 * models.TREE_BYTES)
    assert 0 < memory < 4 << 30
    assert models.remembers(rows // 2, 50, spark) and not models.remembers(2 * rows, 50, spark)


def test_columns_derived_after_the_layout_are_the_same(spark, small, clean, tmp_path):
    """What follows from a row alone does not pass through the shuffle by month."""
    path, widths = str(tmp_path / "clean"), []
    kept = cleaning.kept_rows(trips(spark, small), ANY_PERIOD)

    def derive(laid_out):
        widths.append(len(laid_out.columns))
        return cleaning.finished(laid_out)

    writers.write_partitioned(kept, path, derive=derive)
    back = readers.read_table(spark, path)
    assert widths == [len(kept.columns)] and widths[0] + 10 == len(back.columns)
    assert back.columns == clean.columns and back.count() == clean.count()
    assert back.exceptAll(clean).isEmpty()


def test_split_keeps_every_row(prepared, clean):
    complete = features.complete_inputs(clean).count()
    assert prepared.train.count() + prepared.test.count() == complete
    assert prepared.classes.agg(F.sum("row_count")).first()[0] == complete


def test_stages_come_from_train_rows_unless_asked(clean, tmp_path):
    kinds = {
        kind: features.prepare(clean, str(tmp_path / kind), fit_on=kind, keys=TRIP_KEYS).stages.stages[-1]
        for kind in ("train", "all")
    }
    whole = features.complete_inputs(clean).agg(F.avg("trip_distance")).first()[0]
    assert kinds["all"].mean[2] == pytest.approx(whole)
    assert kinds["train"].mean[2] != pytest.approx(whole, rel=1e-9)


def test_only_splits_of_the_same_version_are_read_back(spark, clean, tmp_path):
    folder = str(tmp_path / "prep")
    n = features.prepare(clean, folder, keys=TRIP_KEYS, version="a").train.count()
    same = features.prepare(clean.limit(0), folder, keys=TRIP_KEYS, version="a")
    assert same.train.count() == n and len(same.train.first().features) == 26
    half = clean.filter("l_orderkey % 2 = 0")
    other = features.prepare(half, folder, keys=TRIP_KEYS, version="b")
    assert other.train.count() + other.test.count() == features.complete_inputs(half).count()


def test_a_crash_between_splits_and_stages_is_not_reused(spark, clean, tmp_path, monkeypatch):
    folder = str(tmp_path / "prep")
    n = features.prepare(clean, folder, keys=TRIP_KEYS, version="a").train.count()
    with monkeypatch.context() as broken:
        broken.setattr(features, "save_model", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            features.prepare(clean.filter("l_orderkey % 2 = 0"), folder, keys=TRIP_KEYS, version="b")
    assert features.prepare(clean, folder, keys=TRIP_KEYS, version="a").train.count() == n


def test_unseen_categories_and_null_numbers(clean, prepared):
    rows = features.complete_inputs(clean).limit(3)
    odd = rows.withColumn("time_of_day", F.lit("dawn"))
    assert prepared.stages.transform(odd).count() == 3
    holes = rows.withColumn("fare_amount", F.lit(None).cast("double"))
    assert prepared.stages.transform(holes).count() == 0


def test_classifier_beats_thresholds(prepared, forest, spark, clean):
    scored = scoring.score_by_model(prepared.test, forest)
    metrics = {r.metric: r.value for r in models.classifier_metrics(scored).collect()}
    share = prepared.test.agg(F.avg("generous_tipper")).first()[0]
    assert metrics["accuracy"] >= max(share, 1 - share) - 0.05
    for ours, theirs in (("f1", "f1"), ("precision", "weightedPrecision"), ("recall", "weightedRecall")):
        judge = MulticlassClassificationEvaluator(labelCol="generous_tipper", metricName=theirs)
        assert metrics[ours] == pytest.approx(judge.evaluate(scored), abs=1e-4)
    top = models.feature_importances(spark, forest, features.slot_names(prepared.stages, clean))
    found = [r.importance for r in top.collect()]
    assert len(found) == 10 and found == sorted(found, reverse=True)


def test_saved_model_scores_alike(prepared, forest, tmp_path):
    path = writers.save_model(forest, str(tmp_path / "rf"))
    again = readers.load_classifier(path)
    columns = ("generous_tipper", "prediction", "confidence")
    one = scoring.score_by_model(prepared.test, forest).select(*columns)
    two = scoring.score_by_model(prepared.test, again).select(*columns)
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_requests_are_scored_by_the_model(spark, prepared, forest):
    from meterline.operators import rules

    request = {"payment_type": 1, "trip_distance": 3.5, "fare_amount": 15.0, "trip_duration_min": 18.0,
               "pickup_hour": 18, "pickup_dayofweek": 6}
    table = rules.with_request_defaults(readers.requests_table(spark, [request, {**request, "payment_type": 2}]))
    scored = scoring.score_requests(table, "model", prepared.stages, forest)
    got = scoring.responses(scored).collect()
    assert len(got) == 2 and {r.inference_method for r in got} == {"spark_model"}
    assert "Python" not in scored._jdf.queryExecution().executedPlan().toString()


def test_gathered_requests_get_the_same_scores(spark, small, prepared, forest):
    """The forest meets similar requests one after the other; none is lost and each is scored as before."""
    from meterline.operators import rules
    from meterline.plans import catalog

    valid, _ = rules.quarantine(catalog._requests(spark, small), rules.request_rules())
    plain, near = (scoring.score_requests(valid, "model", prepared.stages, forest, gather=g) for g in (False, True))
    one, two = (scoring.responses(scored, *TRIP_KEYS) for scored in (plain, near))
    assert one.count() == two.count() > 1000 and one.columns == two.columns
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()
    met = [tuple(x > 0 for x in r.features) for r in near.select("features").coalesce(1).collect()]
    assert met == sorted(met) and len(set(met)) > 1


def test_regressor_solves_the_ridge_equations(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 2)) * [1.0, 5.0]
    y = 2.0 * x[:, 0] - 0.5 * x[:, 1] + 4.0 + rng.normal(size=300) * 0.1
    from pyspark.ml.feature import VectorAssembler

    frame = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], "a double, b double, fare_amount double")
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(frame)
    model = models.train_regressor(vectors)
    # Penalty on coefficients of features scaled to unit (sample) deviation and target likewise.
    xs, ys = (x - x.mean(0)) / x.std(0, ddof=1), (y - y.mean()) / y.std(ddof=1)
    beta = np.linalg.solve(xs.T @ xs / 300 + 0.1 / y.std(ddof=1) * np.eye(2), xs.T @ ys / 300)
    want = beta * y.std(ddof=1) / x.std(0, ddof=1)
    assert np.allclose(model.coefficients.toArray(), want, rtol=0.02)


def test_fare_model(clean):
    model, scored = models.fit_fares(clean)
    row = models.fare_metrics(scored).first()
    assert len(model.coefficients) == 10 and row.rmse > 0 and row.mae <= row.rmse
    # fares of these tables have nothing to do with distance, so the mean is as good a guess
    assert abs(evaluation.regression_metrics(scored, "fare_amount").first().r2) < 0.1


def test_tuning(spark, prepared, forest):
    grid = models.TuningGrid(trees=(2, 4), depths=(2,), least_rows=(1, 5), folds=2, sample=0.5)
    tuned = models.tune_classifier(prepared.train, grid)
    board = models.leaderboard(spark, tuned).collect()
    assert len(board) == 4 and [r.auc for r in board] == sorted((r.auc for r in board), reverse=True)
    tables = [
        models.classifier_metrics(scoring.score_by_model(prepared.test, m)) for m in (forest, tuned.bestModel)
    ]
    compared = models.compare(*tables).collect()
    assert {r.metric for r in compared} == {"auc", "accuracy", "precision", "recall", "f1"}
    assert all(r.delta == pytest.approx(r.tuned - r.baseline, abs=1e-4) for r in compared)


def test_tuning_works_on_every_training_row(prepared, monkeypatch):
    """By default nothing is drawn: each row is in one validation part, and the best model is fitted on all of them."""
    validated, evaluator = [], models._roc_evaluator("generous_tipper")
    evaluate = type(evaluator).evaluate

    def counting(self, rows, *params):
        validated.append(rows.count())
        return evaluate(self, rows, *params)

    monkeypatch.setattr(type(evaluator), "evaluate", counting)
    found = models.tune_classifier(prepared.train, models.TuningGrid(trees=(2,), depths=(2,), least_rows=(1,)))
    assert len(validated) == 3 and sum(validated) == prepared.train.count()
    assert found.bestModel.summary.predictions.count() == prepared.train.count()


def test_parts_of_folds_share_no_row(prepared):
    """Whole rows are not held for the folds, yet both parts meet the same numbers."""
    drawn = lambda: prepared.train.select("*", F.rand(models.SEED).alias("at"))
    one, two = drawn().filter("at >= 0.3"), drawn().filter("NOT at >= 0.3")
    columns = ["features", "generous_tipper"]
    together = one.select(columns).unionAll(two.select(columns))
    near = lambda rows: rows.select("generous_tipper", F.transform(vector_to_array("features"), lambda x: F.round(x, 6)))
    assert near(together).exceptAll(near(prepared.train)).isEmpty() and together.count() == prepared.train.count()


# --- jobs --------------------------------------------------------------------


def test_etl_job_from_monthly_files(spark, make_trips, tmp_path):
    paths = []
    for month in ("2023-01", "2023-02"):
        path = str(tmp_path / f"trips_{month}.parquet")
        stamp = {"tpep_pickup_datetime": f"{month}-05 08:00:00", "tpep_dropoff_datetime": f"{month}-05 08:20:00"}
        make_trips(stamp, stamp, {**stamp, "fare_amount": 1.0}).drop("source_month").write.parquet(path)
        paths.append(path)
    settings = jobs.RunSettings(str(tmp_path / "run"), verify=True)
    source = jobs.extract(spark, paths)
    assert {r.source_month: r.row_count for r in source.profile().collect()} == {"2023-01": 3, "2023-02": 3}
    report = jobs.run_etl(lambda: source.trips, settings, spark).collect()
    assert [(r.phase, r.status, r.row_count) for r in report] == [
        ("extract", "SUCCESS", 6), ("transform", "SUCCESS", None), ("load", "SUCCESS", 2),
        ("reduction", "SUCCESS", 4),
    ]
    summary = spark.read.option("header", True).csv(settings.report_path("trip_summary"))
    assert summary.count() == 2


def test_failing_phase_is_reported_and_raised(spark, make_trips, tmp_path):
    settings = jobs.RunSettings(str(tmp_path / "run"))
    with pytest.raises(jobs.RunFailed, match="transform") as failure:
        jobs.run_etl(lambda: make_trips().drop("fare_amount"), settings, spark)
    statuses = [r.status for r in failure.value.report.collect()]
    assert statuses[0] == "SUCCESS" and statuses[1].startswith("FAILED") and statuses[2] == "NOT RUN"


def run_settings(folder, **more):
    return jobs.RunSettings(str(folder), limits=ANY_PERIOD, forest=models.ForestSettings(trees=3, depth=3), split_keys=tuple(TRIP_KEYS), **more)


def rows_of(run):
    return {r.phase: r.row_count for r in run.report.collect()}


def test_full_run_and_rerun(spark, small, tmp_path):
    settings = run_settings(tmp_path / "run", if_present="skip")
    first = jobs.run_all(lambda: trips(spark, small), settings, spark)
    assert [r.status for r in first.report.collect()] == ["SUCCESS"] * 5
    row = first.summary.first()
    assert row.total_predictions == first.prepared.test.count() == rows_of(first)["predict"]
    assert row.predicted_generous + row.predicted_not_generous == row.total_predictions
    stamp = scratch.file_sizes(spark, [f"{settings.model_path}/metadata/_SUCCESS"])
    second = jobs.run_all(lambda: trips(spark, small), settings, spark)
    assert tuple(second.summary.first()) == tuple(row) and rows_of(second) == rows_of(first)
    assert scratch.file_sizes(spark, [f"{settings.model_path}/metadata/_SUCCESS"]) == stamp  # not trained again
    saved = spark.read.parquet(settings.predictions_path)
    assert saved.columns == ["generous_tipper", "prediction", "confidence"]


@pytest.mark.parametrize("if_present", ["skip", "overwrite"])
def test_new_rows_leave_nothing_stale(spark, small, tmp_path, if_present):
    settings = run_settings(tmp_path / "run", if_present=if_present)
    tables = [str(tmp_path / n) for n in ("part", "all")]
    trips(spark, small).filter("l_orderkey % 2 = 0").write.parquet(tables[0])
    trips(spark, small).write.parquet(tables[1])
    runs = [jobs.run_all(lambda t=t: spark.read.parquet(t), settings, spark) for t in tables]
    part, whole = map(rows_of, runs)
    assert part["etl"] < whole["etl"] == whole["prepare"]
    assert whole["predict"] == runs[1].prepared.test.count() == runs[1].summary.first().total_predictions
    assert whole["train"] + whole["predict"] == whole["etl"]


def test_new_rows_of_the_same_files_and_in_memory_are_noticed(spark, small, tmp_path):
    """A filter over the same files and a source without files: the second run sees other rows."""
    settings = run_settings(tmp_path / "run", if_present="skip")
    half, whole = trips(spark, small).filter("l_orderkey % 2 = 0"), trips(spark, small)
    held = whole.filter("l_orderkey % 3 = 0").toArrow()
    memory = spark.createDataFrame(held)
    counts = []
    for source in (half, whole, memory, memory.repartition(3)):
        done = jobs.run_all(lambda s=source: s, settings, spark)
        made = rows_of(done)
        assert made["etl"] == made["prepare"] == made["train"] + made["predict"] == jobs.transform(source, ANY_PERIOD).count()
        counts.append((made["etl"], scratch.file_sizes(spark, [f"{settings.model_path}/metadata/_SUCCESS"])))
    assert len({n for n, _ in counts[:3]}) == 3 and counts[2] == counts[3]  # the same rows in another layout are read back


def test_changed_settings_train_again(spark, small, tmp_path):
    settings = run_settings(tmp_path / "run", if_present="skip")
    jobs.run_all(lambda: trips(spark, small), settings, spark)
    larger = replace(settings, forest=models.ForestSettings(trees=4, depth=2))
    jobs.run_all(lambda: trips(spark, small), larger, spark)
    assert readers.load_classifier(settings.model_path).getNumTrees == 4


def test_an_unreachable_database_is_told(spark, small, tmp_path):
    lost = jobs.Database("jdbc:nobody://nowhere/none")
    settings = run_settings(tmp_path / "run", database=lost)
    report = {r.phase: r.status for r in jobs.run_etl(lambda: trips(spark, small), settings, spark).collect()}
    assert report["load"].startswith("SUCCESS; csv fallback: ")
    with pytest.raises(jobs.RunFailed, match="load"):
        jobs.run_etl(lambda: trips(spark, small), replace(settings, database_required=True), spark)


def test_no_valid_row(spark, make_trips, tmp_path):
    bad = make_trips({"fare_amount": 1.0}, {"fare_amount": 0.0})
    report = jobs.run_etl(lambda: bad, jobs.RunSettings(str(tmp_path / "run")), spark).collect()
    assert [(r.phase, r.row_count) for r in report] == [("extract", 2), ("transform", None), ("load", 0), ("reduction", 2)]


def test_training_job(spark, clean, tmp_path):
    grid = models.TuningGrid(trees=(2, 3), depths=(2,), least_rows=(1,), folds=2, sample=0.5, parallelism=1)
    done = jobs.run_training(clean, run_settings(tmp_path / "run"), spark, grid)
    report = {r.phase: (r.status, r.row_count) for r in done.report.collect()}
    assert all(status == "SUCCESS" for status, _ in report.values()) and report["tune"][1] == 2
    assert {r.metric for r in done.comparison.collect()} == {"auc", "accuracy", "precision", "recall", "f1"}
    assert done.fares.count() > 0
    assert readers.load_regressor(run_settings(tmp_path / "run").fare_model_path).numFeatures == 10


def test_writes_are_counted_as_they_pass(spark, small, tmp_path):
    """No option is needed, the table is cleaned once, and months that stay do not disturb the count."""
    settings = run_settings(tmp_path / "run", if_present="overwrite_partitions")
    assert settings.verify == "passing"
    clean = jobs.transform(trips(spark, small), ANY_PERIOD)
    first = jobs.load(clean.filter("source_month < '1996'"), settings)
    second = jobs.load(clean.filter("source_month >= '1995-12'"), settings)
    assert first.rows < second.rows == clean.count()


def test_lost_rows_are_noticed(spark, small, tmp_path, monkeypatch):
    write = jobs.writers.write_partitioned
    monkeypatch.setattr(jobs.writers, "write_partitioned", lambda df, *a, **k: write(df.limit(3), *a, **k))
    with pytest.raises(jobs.RunFailed, match="load"):
        jobs.run_etl(lambda: trips(spark, small), run_settings(tmp_path / "run", verify=True), spark)
