"""The registered queries: every operator over the given tables, whole."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline import scratch
from meterline.functions.hashing import portable_hash, row_hash
from meterline.functions.temporal import day_part, elapsed_seconds, weekend_flag
from meterline.ml import categories, features, models
from meterline.operators import (
    cleaning,
    evaluation,
    explore,
    profile,
    reports,
    rules,
    sampling,
    scoring,
)
from meterline.plans import jobs
from meterline.plans.bindings import ANY_PERIOD, ONE_YEAR, TRIP_KEYS, table, trips
from meterline.schema import (
    CLEAN_COLUMNS,
    DROPOFF,
    FARE_TARGET,
    LABEL,
    MONTH,
    NULL_DEFAULTS,
    PICKUP,
)
from meterline.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]

_REGISTERED: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its function's name."""
    _REGISTERED[function.__name__] = function
    return function


def registered() -> dict[str, Query]:
    return dict(_REGISTERED)


# --- Shared inputs -----------------------------------------------------------


def _clean(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_rows(trips(spark, folder), ANY_PERIOD)


def _requests(spark: SparkSession, folder: str) -> DataFrame:
    """Scoring requests with some optional fields left out: one per raw trip."""
    minutes = F.expr(f"({elapsed_seconds(PICKUP, DROPOFF)}) / 60D")
    wide = cleaning.add_features(trips(spark, folder)).withColumn("trip_duration_min", minutes)
    names = [name.split()[0] for name in readers.REQUEST_SCHEMA.split(", ")]
    return rules.with_request_defaults(wide.select(*TRIP_KEYS, *names))


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.score_by_rules(_clean(spark, folder))


def _by_key() -> Column:
    return portable_hash(TRIP_KEYS)


# --- Clean table and its summary ---------------------------------------------


@query
def trip_summary(spark, folder):
    return reports.trip_summary(_clean(spark, folder))


@query
def trip_summary_after_dedup(spark, folder):
    raw = trips(spark, folder)
    return reports.trip_summary(cleaning.clean_trips(raw.unionByName(raw), ANY_PERIOD))


@query
def clean_trips_count_by_month(spark, folder):
    return reports.group_sizes(_clean(spark, folder), MONTH)


@query
def clean_trips_in_year(spark, folder):
    clean = cleaning.clean_trips(trips(spark, folder), ONE_YEAR)
    return reports.group_sizes(clean, MONTH, "time_of_day")


@query
def reduction_report(spark, folder):
    return reports.reduction(trips(spark, folder), _clean(spark, folder))


@query
def reduction_report_by_month(spark, folder):
    return reports.reduction_by(trips(spark, folder), _clean(spark, folder))


@query
def derived_features(spark, folder):
    clean = cleaning.derive_trips(trips(spark, folder), ANY_PERIOD)
    return clean.select(
        *TRIP_KEYS,
        "trip_duration_min",
        "pickup_hour",
        "pickup_dayofweek",
        "is_weekend",
        "time_of_day",
        "avg_speed_mph",
        "tip_pct",
        "is_airport_trip",
        "fare_per_mile",
        LABEL,
    )


@query
def final_projection(spark, folder):
    return cleaning.clean_columns(_clean(spark, folder))


@query
def leakage_free_columns(spark, folder):
    return cleaning.without_leakage(cleaning.clean_columns(_clean(spark, folder)))


@query
def regressor_inputs(spark, folder):
    return cleaning.fare_inputs(_clean(spark, folder))


@query
def dedup_rows(spark, folder):
    raw = trips(spark, folder)
    single = cleaning.drop_copies(raw.unionByName(raw))
    return single.select(*TRIP_KEYS, "fare_amount", "tip_amount", "total_amount", MONTH)


# --- Rules -------------------------------------------------------------------


def _all_rules() -> list[rules.Rule]:
    return [*rules.trip_rules(ONE_YEAR), *rules.physics_rules(ONE_YEAR)]


@query
def rule_audit(spark, folder):
    return rules.audit(trips(spark, folder), _all_rules())


@query
def first_failing_rule(spark, folder):
    return rules.first_failure(trips(spark, folder), _all_rules())


@query
def optional_rule_audit(spark, folder):
    return rules.audit(trips(spark, folder), rules.optional_trip_rules())


@query
def validated_requests(spark, folder):
    tagged = rules.tag_violations(_requests(spark, folder), rules.request_rules())
    return tagged.select(
        *TRIP_KEYS, F.array_join("violations", ",").alias("violations"), "congestion_surcharge"
    )


@query
def quarantine_counts(spark, folder):
    _, rejected = rules.quarantine(_requests(spark, folder), rules.request_rules())
    return reports.group_sizes(rejected.select(F.explode("violations").alias("rule")), "rule")


@query
def sorted_out_audit(spark, folder):
    """The audit that the write of valid and rejected trips took along."""
    return rules.sort_out(trips(spark, folder), _all_rules(), scratch.fresh_path(spark, "sorted"), [MONTH]).audit


@query
def sorted_out_requests(spark, folder):
    """Valid requests and rejected ones by rule, as one pass wrote them."""
    done = rules.sort_out(_requests(spark, folder), rules.request_rules(), scratch.fresh_path(spark, "sorted"))
    valid = done.valid.select(F.lit("accepted").alias("rule"))
    failed = done.rejected.select(F.explode("violations").alias("rule"))
    return reports.group_sizes(valid.unionAll(failed), "rule")


@query
def null_counts(spark, folder):
    return profile.null_counts(trips(spark, folder))


@query
def null_defaults_profile(spark, folder):
    filled = cleaning.fill_defaults(trips(spark, folder))
    return reports.group_sizes(filled, *NULL_DEFAULTS)


@query
def dropna_count(spark, folder):
    return reports.group_sizes(trips(spark, folder).dropna(), MONTH)


# --- Profiles and explorer ---------------------------------------------------


@query
def describe_numeric(spark, folder):
    columns = ["trip_distance", "fare_amount", "tip_amount", "total_amount", "passenger_count"]
    return profile.numeric_summary(trips(spark, folder), columns, digits=6)


@query
def describe_small_values(spark, folder):
    """Values too small for sums in fixed units; compared in millionths of a billionth."""
    small = table(spark, folder, "lineitem").select((F.col("l_discount") / 1e9).alias("l_discount"))
    found = profile.numeric_summary(small, ["l_discount"])
    return found.withColumn("l_discount", F.when(F.col("summary") == "count", F.col("l_discount")).otherwise(F.round(F.col("l_discount") * 1e15, 0)))


@query
def means_of_small_values(spark, folder):
    """Exact means of values from 1e-5 to 1e-3, whose every bit counts."""
    small = table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", (F.col("l_extendedprice") / 1e8).alias("price"))
    sums = reports.sums_of(small, ["l_returnflag", "l_linestatus"], ["price"])
    return sums.select("l_returnflag", "l_linestatus", "row_count", F.col("sum_price"), reports.mean_from("price").alias("avg_price"))


@query
def reduction_report_null_months(spark, folder):
    """Trips whose month is not known keep a row of their own."""
    some = F.when(F.col("l_orderkey") % 5 != 0, F.col(MONTH))
    return reports.reduction_by(
        trips(spark, folder).withColumn(MONTH, some), _clean(spark, folder).withColumn(MONTH, some)
    )


@query
def class_distribution(spark, folder):
    return reports.distribution(_clean(spark, folder), LABEL)


@query
def tip_by_hour(spark, folder):
    return reports.tip_share_by(_clean(spark, folder), "pickup_hour")


@query
def tip_by_time_of_day(spark, folder):
    return reports.tip_share_by(_clean(spark, folder), "time_of_day", digits=4)


@query
def fare_by_bucket_and_payment(spark, folder):
    return reports.fare_by(_clean(spark, folder), "time_of_day", "payment_type")


@query
def fare_by_time_of_day(spark, folder):
    return reports.fare_by(_clean(spark, folder), "time_of_day", digits=2)


@query
def filtered_counts(spark, folder):
    return reports.counts_where(
        _clean(spark, folder),
        generous=F.col(LABEL) == 1,
        airport=F.col("is_airport_trip") == 1,
        one_month=F.col(MONTH) == "1995-03",
    )


@query
def global_avg(spark, folder):
    return reports.overall_mean(_clean(spark, folder), "fare_amount")


@query
def kpis(spark, folder):
    return explore.key_figures(_clean(spark, folder))


_EXPLORER_CHOICE = explore.Filters(
    months=("1995-03", "1995-04", "1996-07"),
    day_parts=("morning", "evening"),
    airport=False,
    payment="Cash",
)


@query
def explorer_filtered(spark, folder):
    shown = explore.apply_filters(_clean(spark, folder), _EXPLORER_CHOICE)
    return explore.key_figures(shown)


@query
def explorer_unfiltered_by_hour(spark, folder):
    shown = explore.apply_filters(_clean(spark, folder), explore.Filters())
    return explore.trips_by_hour(shown)


@query
def explorer_payment_code_by_hour(spark, folder):
    shown = explore.apply_filters(_clean(spark, folder), explore.Filters(payment="5"))
    return explore.trips_by_hour(shown)


@query
def generous_by_payment(spark, folder):
    return explore.generous_by_payment(_clean(spark, folder))


@query
def fare_histogram(spark, folder):
    return explore.histogram(_clean(spark, folder), "fare_amount", 40, clip_to=(0.0, 80.0))


@query
def value_histogram(spark, folder):
    return explore.histogram(table(spark, folder, "events"), "value", 40)


@query
def confidence_histogram(spark, folder):
    return explore.histogram(_scored(spark, folder), "confidence", 30)


@query
def events_by_hour(spark, folder):
    hours = table(spark, folder, "events").select(F.hour("ts").alias("pickup_hour"))
    return explore.trips_by_hour(hours)


@query
def events_weekend_share(spark, folder):
    events = table(spark, folder, "events")
    marked = events.select(
        F.concat_ws(
            "/", weekend_flag("dayofweek(ts)").cast("string"), day_part("hour(ts)")
        ).alias("slot")
    )
    return reports.distribution(marked, "slot")


@query
def filter_menu_values(spark, folder):
    return profile.menu_values(_clean(spark, folder), MONTH)


# --- Samples, order, limits --------------------------------------------------


@query
def topn_trips(spark, folder):
    clean = _clean(spark, folder)
    ordered = clean.orderBy(F.desc("fare_amount"), *TRIP_KEYS).limit(10)
    return ordered.select(*TRIP_KEYS, "fare_amount", "tip_amount")


@query
def fixed_sample(spark, folder):
    rows = _clean(spark, folder).select(*TRIP_KEYS, "fare_amount", LABEL)
    return sampling.fixed_size(rows, 500, _by_key())


@query
def bernoulli_sample(spark, folder):
    rows = _clean(spark, folder).select(*TRIP_KEYS, "fare_amount", LABEL)
    return sampling.bernoulli(rows, 0.2, by=_by_key())


@query
def split_sizes(spark, folder):
    train, test = sampling.train_test(_clean(spark, folder), by=_by_key())
    both = train.select(LABEL, F.lit("train").alias("part")).unionByName(
        test.select(LABEL, F.lit("test").alias("part"))
    )
    return reports.group_sizes(both, "part", LABEL)


@query
def random_split_total(spark, folder):
    rows = _clean(spark, folder).select(*TRIP_KEYS, LABEL)
    train, test = sampling.random_split(rows, [0.8, 0.2])
    return reports.group_sizes(train.unionByName(test), LABEL)


# --- Sources and sinks -------------------------------------------------------


@query
def reconciled_union(spark, folder):
    """Two files of the same orders table whose schemas drifted apart."""
    orders = table(spark, folder, "orders")
    year = F.year("o_orderdate")
    place = scratch.fresh_path(spark, "drift")
    older, newer = f"{place}/orders_1994-12.parquet", f"{place}/orders_1998-12.parquet"
    early = orders.filter(F.col("o_orderdate") < "1995-01-01").select(
        *[F.col(c).alias(c.upper()) for c in orders.columns], year.alias("RateCodeID")
    )
    late = orders.filter(F.col("o_orderdate") >= "1995-01-01").select(
        "*", year.cast("long").alias("ratecodeid"), F.lit("new").alias("only_here")
    )
    writers.write_table(early, older)
    writers.write_table(late, newer)
    union, _ = readers.read_months(spark, [older, newer])
    return union.drop("o_orderdate")


@query
def dropped_columns(spark, folder):
    """What a union of three files, two of one month, leaves out: a column one file lacks."""
    orders = table(spark, folder, "orders")
    place = scratch.fresh_path(spark, "folders")
    writers.write_table(orders.filter("o_orderkey % 2 = 0"), f"{place}/orders_1994-12.parquet")
    orders.filter("o_orderkey % 2 = 1").drop("o_orderpriority").write.mode("append").parquet(f"{place}/orders_1994-12.parquet")
    writers.write_table(orders.withColumn("only_here", F.lit(1)), f"{place}/orders_1995-01.parquet")
    union, report = readers.read_months(spark, [f"{place}/orders_1994-12.parquet", f"{place}/orders_1995-01.parquet"])
    left = {c for columns in report.dropped.values() for c in columns}
    return union.groupBy(MONTH).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("o_custkey").alias("customers"), F.lit(",".join(sorted(left))).alias("dropped")
    )


@query
def lookup_csv_roundtrip(spark, folder):
    """A zone lookup made of the customers, as CSV and back."""
    zones = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("LocationID"),
        F.col("c_mktsegment").alias("Borough"),
        F.col("c_name").alias("Zone"),
        F.col("c_nationkey").cast("string").alias("service_zone"),
    )
    path = writers.write_csv(zones, scratch.fresh_path(spark, "zones"))
    return readers.read_lookup(spark, path)


def _zones_with_bad_lines(spark: SparkSession, folder: str) -> str:
    """The same lookup as text, in which some lines have a field too many, one too few, or a word for a number."""
    key = F.col("c_custkey")
    zone = F.concat(F.lit('"'), F.col("c_name"), F.lit(', "'))
    usual = [key.cast("string"), F.col("c_mktsegment"), F.regexp_replace(zone, ', "', ', x"'), F.col("c_nationkey").cast("string")]
    line = (
        F.when(key % 11 == 0, F.concat_ws(",", *usual, F.lit("more")))
        .when(key % 13 == 0, F.concat_ws(",", *usual[:3]))
        .when(key % 17 == 0, F.concat_ws(",", F.lit("none"), *usual[1:]))
        .otherwise(F.concat_ws(",", *usual))
    )
    path = scratch.fresh_path(spark, "zones")
    table(spark, folder, "customer").select(line.alias("value")).write.text(path)
    return path


@query
def lookup_with_bad_lines(spark, folder):
    """The good lines of a lookup."""
    return readers.read_lookup_checked(spark, _zones_with_bad_lines(spark, folder), header=False)[0]


@query
def lookup_rejects(spark, folder):
    """The bad lines of a lookup, and why they were rejected."""
    rejects = readers.read_lookup_checked(spark, _zones_with_bad_lines(spark, folder), header=False)[1]
    return rejects.select("line", "reason")


def _written(spark: SparkSession, folder: str) -> str:
    path = scratch.fresh_path(spark, "clean")
    writers.write_partitioned(cleaning.clean_columns(_clean(spark, folder)), path)
    return path


@query
def partitioned_roundtrip(spark, folder):
    return writers.count_partitions(spark, _written(spark, folder))


@query
def one_partition(spark, folder):
    month = readers.read_partition(spark, _written(spark, folder), "1995-03")
    return reports.group_sizes(month, MONTH, "time_of_day")


@query
def one_month_filtered(spark, folder):
    month = readers.read_table(spark, _written(spark, folder), "1995-03")
    return reports.fare_by(month, "time_of_day", "payment_type")


@query
def written_sample(spark, folder):
    """A sample of fixed size of a written table."""
    saved = readers.read_table(spark, _written(spark, folder))
    rows = sampling.fixed_size(saved, 500, row_hash(["fare_amount", "trip_distance", "trip_duration_min", MONTH]))
    return rows.agg(F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("fare_amount") >= 2.5).alias("valid"))


@query
def rewritten_partitions(spark, folder):
    """A table written twice: skipped as a whole, then one month replaced by half of it."""
    path = _written(spark, folder)
    clean = cleaning.clean_columns(_clean(spark, folder))
    writers.write_partitioned(clean.limit(0), path, if_present="skip")
    part = clean.filter((F.col(MONTH) == "1995-03") & (F.col("vendorid") == 1))
    writers.write_partitioned(part, path, if_present="overwrite_partitions")
    return writers.count_partitions(spark, path)


@query
def summary_csv_delivery(spark, folder):
    """The summary without a database: one CSV file, read back with its types."""
    summary = reports.trip_summary(_clean(spark, folder))
    path = scratch.fresh_path(spark, "summary")
    sent = writers.deliver_report(summary, "trip_summary", None, None, path)
    return spark.read.option("header", True).schema(summary.schema).csv(sent.location)


# --- Scoring by rules --------------------------------------------------------


@query
def rule_scored(spark, folder):
    return _scored(spark, folder).select(
        *TRIP_KEYS, "prediction", "confidence", "inference_method"
    )


@query
def rule_scored_night(spark, folder):
    rule = scoring.RuleScore(scoring.EVENING_AND_NIGHT_HOURS)
    return scoring.score_by_rules(_clean(spark, folder), rule).select(
        *TRIP_KEYS, "prediction", "confidence"
    )


@query
def rule_score_summary(spark, folder):
    return scoring.prediction_summary(_scored(spark, folder))


@query
def prediction_figures(spark, folder):
    return scoring.prediction_figures(_scored(spark, folder))


@query
def scored_responses(spark, folder):
    valid, _ = rules.quarantine(_requests(spark, folder), rules.request_rules())
    return scoring.responses(scoring.score_requests(valid), *TRIP_KEYS)


# --- Evaluation --------------------------------------------------------------


@query
def confusion_matrix(spark, folder):
    return evaluation.confusion_matrix(_scored(spark, folder))


@query
def class_metrics(spark, folder):
    return evaluation.class_metrics(_scored(spark, folder))


@query
def weighted_metrics(spark, folder):
    found = evaluation.weighted_metrics(_scored(spark, folder))
    return found.select(*[F.round(c, 6).alias(c) for c in found.columns])


@query
def prediction_distribution(spark, folder):
    return evaluation.prediction_shares(_scored(spark, folder))


@query
def auc(spark, folder):
    return evaluation.area_under_roc(_scored(spark, folder))


@query
def regression_metrics(spark, folder):
    guess = F.col("trip_distance") * F.lit(2.5) + F.lit(3.0)
    predicted = _clean(spark, folder).withColumn("prediction", guess)
    return evaluation.regression_metrics(predicted, FARE_TARGET, digits=6)


# --- Models ------------------------------------------------------------------


@dataclass(frozen=True)
class _Workspace:
    """Prepared rows and the path of the classifier fitted on them."""

    prepared: features.Prepared
    inputs: DataFrame
    model_path: str

    def model(self) -> RandomForestClassificationModel:
        return readers.load_classifier(self.model_path)

    def scored(self) -> DataFrame:
        return scoring.score_by_model(self.prepared.test, self.model())


def _model_table(kept: DataFrame) -> DataFrame:
    """The columns of the clean table, and the keys that the split needs."""
    return cleaning.finished(kept).select(*CLEAN_COLUMNS, *TRIP_KEYS)


_WORKSPACES: dict[tuple[str, str], _Workspace] = {}


def _workspace(spark: SparkSession, folder: str) -> _Workspace:
    """Prepare and train once per session and folder; the queries on models share it."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _WORKSPACES:
        place = scratch.fresh_path(spark, "ml")
        path = f"{place}/clean"
        kept = cleaning.kept_rows(trips(spark, folder), ANY_PERIOD)
        writers.write_partitioned(kept, path, derive=_model_table)
        inputs = readers.read_table(spark, path)
        prepared = features.prepare(inputs, f"{place}/ml", keys=TRIP_KEYS, by=_by_key(), written=True)
        model_path = f"{place}/classifier"
        writers.save_model(models.train_classifier(prepared.train), model_path)
        _WORKSPACES[key] = _Workspace(prepared, inputs, model_path)
    return _WORKSPACES[key]


@query
def string_index_levels(spark, folder):
    inputs = features.complete_inputs(_workspace(spark, folder).inputs)
    return features.index_levels(spark, features.feature_stages().fit(inputs))


@query
def feature_scaling(spark, folder):
    inputs = features.complete_inputs(_workspace(spark, folder).inputs)
    stages = features.feature_stages().fit(inputs)
    found = features.scale_parameters(spark, stages, inputs)
    return found.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@query
def feature_vectors(spark, folder):
    ready = _workspace(spark, folder).prepared
    vectors = ready.train.unionByName(ready.test)
    size = F.size(vector_to_array("features"))
    return vectors.groupBy(LABEL).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(size).alias("least_size"),
        F.max(size).alias("most_size"),
    )


@query
def split_reload(spark, folder):
    ready = _workspace(spark, folder).prepared
    both = ready.train.select(LABEL, F.lit("train").alias("part")).unionByName(
        ready.test.select(LABEL, F.lit("test").alias("part"))
    )
    return both.groupBy("part").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(LABEL).alias("generous")
    )


@query
def rf_predictions(spark, folder):
    return _workspace(spark, folder).scored().select(LABEL, "prediction", "confidence")


@query
def rf_metrics(spark, folder):
    return models.classifier_metrics(_workspace(spark, folder).scored())


@query
def rf_importance_top10(spark, folder):
    space = _workspace(spark, folder)
    names = features.slot_names(space.prepared.stages, space.inputs)
    return models.feature_importances(spark, space.model(), names)


@query
def model_reload_scores(spark, folder):
    """Label counts of the rows that a reloaded model scored."""
    scored = _workspace(spark, folder).scored()
    return scored.filter(F.col("prediction").isin(0.0, 1.0)).groupBy(LABEL).agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query
def prediction_files(spark, folder):
    path = writers.write_predictions(
        _workspace(spark, folder).scored(), scratch.fresh_path(spark, "predictions")
    )
    saved = spark.read.parquet(path)
    return saved.agg(F.count(F.lit(1)).alias("row_count"), F.sum(LABEL).alias("generous"))


@query
def model_scored_requests(spark, folder):
    space = _workspace(spark, folder)
    valid, _ = rules.quarantine(_requests(spark, folder), rules.request_rules())
    scored = scoring.score_requests(valid, "model", space.prepared.stages, space.model(), gather=True)
    return scoring.responses(scored, *TRIP_KEYS)


@query
def lr_predictions(spark, folder):
    _, scored = models.fit_fares(_workspace(spark, folder).inputs)
    return scored.select(FARE_TARGET, F.round("prediction", 4).alias("prediction"))


@query
def lr_metrics(spark, folder):
    _, scored = models.fit_fares(_workspace(spark, folder).inputs)
    return models.fare_metrics(scored)


@query
def lr_slopes(spark, folder):
    """The fare model is at the minimum of its ridge equations: all slopes round to zero."""
    model, fitted, _ = models.fit_fare_parts(_workspace(spark, folder).inputs)
    found = models.ridge_slopes(model, fitted)
    return found.withColumn("slope", F.round("slope", 4) + F.lit(0.0))


@query
def rf_decisions(spark, folder):
    """A forest decides for the class whose probability exceeds a half; label counts beside it."""
    scored = _workspace(spark, folder).scored()
    likely = vector_to_array("probability")[1]
    return scored.groupBy(LABEL).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if((F.col("prediction") == 1.0) != (likely > 0.5)).alias("other_way"),
        F.count_if(F.abs(F.col("confidence") - F.round(likely, 4)) > 1e-9).alias("other_confidence"),
    )


@query
def rf_importance_total(spark, folder):
    """Importances of all positions: as many as the vector has, and one in total."""
    space = _workspace(spark, folder)
    names = features.slot_names(space.prepared.stages, space.inputs)
    every = models.feature_importances(spark, space.model(), names, top=len(names))
    return every.agg(
        F.count_distinct("feature").alias("features"), F.round(F.sum("importance"), 6).alias("total"),
        F.count_if(F.col("importance") < 0).alias("negative"),
    )


@query
def rf_metrics_from_files(spark, folder):
    """Accuracy of a written prediction file against the metrics table."""
    path = writers.write_predictions(_workspace(spark, folder).scored(), scratch.fresh_path(spark, "predictions"))
    share = F.round(F.avg((F.col("prediction") == F.col(LABEL)).cast("int")), 4)
    counted = spark.read.parquet(path).agg(share.alias("counted"))
    told = models.classifier_metrics(_workspace(spark, folder).scored()).filter("metric = 'accuracy'")
    return told.withColumn("counted", counted.scalar()).select("metric", (F.col("value") - F.col("counted")).alias("difference"))


@query
def request_inputs(spark, folder):
    """What the feature stages get of a request: constants and derived fields beside its own."""
    valid, _ = rules.quarantine(_requests(spark, folder), rules.request_rules())
    wide = scoring.request_features(valid)
    return wide.select(*TRIP_KEYS, "mta_tax", "extra", "tolls_amount", "store_and_fwd_flag", "is_weekend", "time_of_day")


@query
def cv_leaderboard_shape(spark, folder):
    """Every combination of the grid, each with an area between 0 and 1."""
    board = models.leaderboard(spark, _tuned(spark, folder))
    return board.select("trees", "depth", "least_rows", F.col("auc").between(0.0, 1.0).alias("possible"))


@query
def cv_leaderboard(spark, folder):
    return models.leaderboard(spark, _tuned(spark, folder))


@query
def tuned_vs_baseline(spark, folder):
    space = _workspace(spark, folder)
    best = _tuned(spark, folder).bestModel
    tuned = scoring.score_by_model(space.prepared.test, best)
    return models.compare(
        models.classifier_metrics(space.scored()), models.classifier_metrics(tuned)
    )


_TUNED: dict[tuple[str, str], object] = {}


def _tuned(spark: SparkSession, folder: str):
    key = (spark.sparkContext.applicationId, folder)
    if key not in _TUNED:
        _TUNED[key] = models.tune_classifier(_workspace(spark, folder).prepared.train)
    return _TUNED[key]


# --- Jobs --------------------------------------------------------------------


@query
def etl_run_report(spark, folder):
    settings = jobs.RunSettings(scratch.fresh_path(spark, "etl"), limits=ANY_PERIOD)
    report = jobs.run_etl(lambda: trips(spark, folder), settings, spark)
    return report.drop("seconds")


@query
def category_positions(spark, folder):
    """Positions of all parts by how often they are ordered: more categories than a driver should hold."""
    return categories.category_ranks(table(spark, folder, "lineitem"), "l_partkey")


@query
def category_positions_of_lines(spark, folder):
    """Order lines by the position of their part: the 50 commonest by themselves, the rest in one."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    placed = categories.with_positions(lines, "l_partkey", categories.category_ranks(lines, "l_partkey"), "position", head=50)
    return reports.group_sizes(placed, "position")


@query
def months_summary(spark, folder):
    """The summary of a store that first got half of the rows and then all of them."""
    store = jobs.month_store(spark, scratch.fresh_path(spark, "months"), ANY_PERIOD)
    store.update(trips(spark, folder).filter("l_orderkey % 2 = 0"))
    store.update(trips(spark, folder))
    return reports.summary_from(store.summary_sums())


@query
def months_update_report(spark, folder):
    """What an update does to a store that had the months up to 1997 already, 1996 in half."""
    store = jobs.month_store(spark, scratch.fresh_path(spark, "months"), ANY_PERIOD)
    store.update(trips(spark, folder).filter(f"{MONTH} < '1998' AND ({MONTH} < '1996' OR {MONTH} > '1997' OR l_orderkey % 2 = 0)"))
    return store.update(trips(spark, folder))


@query
def full_run_report(spark, folder):
    settings = jobs.RunSettings(
        scratch.fresh_path(spark, "full"),
        limits=ANY_PERIOD,
        split_keys=tuple(TRIP_KEYS),
        split_by=_by_key,
    )
    return jobs.run_all(lambda: trips(spark, folder), settings, spark).report.drop("seconds")
