"""Registered queries for data quality, drift and the delay classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.contracts import contract
from skyledger.functions.casting import conform
from skyledger.functions.fingerprint import dataset_version
from skyledger.functions.measures import INPUTS
from skyledger.operators import evaluation, leaf_trees, monitoring
from skyledger.operators.features import add_temporal, delay_label, route_trailing
from skyledger.operators.flights import FLIGHT_KEY
from skyledger.operators.importance import permutation_importance
from skyledger.plans import model
from skyledger.session import scratch, scratch_path, stage_table
from skyledger.sources.snapshots import Tables
from skyledger.workloads.registry import classified, feature_rows, query, valid

EXPECTATIONS = {
    "flight_number_present": "trim(flight_number) <> ''",
    "airports_differ": "origin_airport <> dest_airport",
    "arrival_after_departure": "scheduled_arrival_ts >= scheduled_departure_ts",
    "cancelled_known": "cancelled_flag IS NOT NULL",
    "delay_in_range": "arrival_delay_minutes BETWEEN -60 AND 600",
}
BASELINE_THRESHOLD = 0.4


@query
def expectations(spark, sf_dir):
    return monitoring.check_expectations(classified(spark, sf_dir), EXPECTATIONS)


def baseline_predictions(flights: DataFrame) -> DataFrame:
    """The trailing late share of the route, taken as the probability of a delay."""
    probability = F.coalesce("route_delay_rate_90d", F.lit(0.0))
    return flights.withColumns({
        "delay_probability": probability,
        "predicted_delayed": probability >= BASELINE_THRESHOLD,
        "is_delayed": delay_label(F.col("arrival_delay_minutes")),
    })


def _clean(spark, sf_dir) -> DataFrame:
    with scratch(spark) as brief:
        return stage_table(valid(spark, sf_dir, brief).select(*FLIGHT_KEY, "route_code", *INPUTS), "clean_flights")


def _baseline(spark, sf_dir) -> DataFrame:
    return _scored(_clean(spark, sf_dir))


def _scored(flights: DataFrame) -> DataFrame:
    return baseline_predictions(
        flights.join(route_trailing(flights), ["route_code", "flight_date"], "left")
    )


@query
def prediction_trend(spark, sf_dir):
    return monitoring.prediction_trend(_baseline(spark, sf_dir))


@query
def route_probability(spark, sf_dir):
    return monitoring.route_probability(_baseline(spark, sf_dir))


@query
def retrain_decision(spark, sf_dir):
    """Predictions are judged once the labels are known; here both come from one table."""
    scored = stage_table(
        _baseline(spark, sf_dir).select(*FLIGHT_KEY, "predicted_delayed", "is_delayed"), "scored"
    )
    return monitoring.retrain_decision(scored, scored, min_accuracy=0.75)


@query
def baseline_metrics(spark, sf_dir):
    return evaluation.classification_metrics(_baseline(spark, sf_dir))


DRIFT_START = "1999-01-01"


@query
def drift_psi(spark, sf_dir):
    rows = stage_table(
        add_temporal(valid(spark, sf_dir)).select(
            "flight_date", "departure_delay_minutes", "arrival_delay_minutes", "distance_miles",
            "dep_hour", "reporting_airline", "season", "dep_hour_bucket",
        ),
        "drift",
    )
    current = F.col("flight_date") >= F.lit(DRIFT_START).cast("date")
    numbers = ("departure_delay_minutes", "arrival_delay_minutes", "distance_miles", "dep_hour")
    texts = ("reporting_airline", "season", "dep_hour_bucket")
    return monitoring.drift(rows, current, numbers, texts)


_PARAMS = model.Params(max_depth=4, learning_rate=0.2, n_estimators=5)


_registries: dict[tuple[str, str], Tables] = {}


def _trained(spark, sf_dir) -> Tables:
    """Publish the features, train on them, register the model.

    The queries below report on one training run: the first of a session makes it, the
    others find it in the registry.
    """
    place = (spark.sparkContext.applicationId, sf_dir)
    if place in _registries:
        return _registries[place]
    tables = Tables(spark, scratch_path(spark, "tables")).create(
        ["gold.ml_features", "silver.flight_operations_clean", "gold.ml_predictions"]
    )
    with scratch(spark) as stage:
        tables.table("gold.ml_features").publish(feature_rows(spark, sf_dir, stage), "overwrite")
    model.run_training(tables, _PARAMS)
    _registries[place] = tables
    return tables


def _run(tables: Tables, column: str, schema: str) -> DataFrame:
    return tables.read("gold.model_runs").select(
        "model_name", "model_version", F.from_json(column, schema).alias("v")
    )


@query
def train_metrics(spark, sf_dir):
    schema = ("evaluated BIGINT, correct BIGINT, accuracy DOUBLE, precision DOUBLE, recall DOUBLE,"
              " f1 DOUBLE, auc_roc DOUBLE")
    return _run(_trained(spark, sf_dir), "metrics", schema).select("model_name", "model_version", "v.*")


@query
def confusion_matrix(spark, sf_dir):
    schema = "ARRAY<STRUCT<is_delayed: BOOLEAN, predicted_delayed: BOOLEAN, flights: BIGINT>>"
    return _run(_trained(spark, sf_dir), "confusion", schema).selectExpr(
        "model_name", "model_version", "inline(v)"
    )


@query
def feature_importance(spark, sf_dir):
    return _run(_trained(spark, sf_dir), "importances", "MAP<STRING, DOUBLE>").selectExpr(
        "model_name", "model_version", "explode(v) AS (feature, importance)"
    )


LEAST_AREA = 0.65  # a model without skill has 0.5


@query
def training_checks(spark, sf_dir):
    """What the training run must report whatever the model is: the flights it was evaluated on,
    a confusion matrix over all of them, every feature weighed, and skill."""
    tables = _trained(spark, sf_dir)
    run = tables.read("gold.model_runs").select(
        "model_version",
        F.from_json("metrics", "evaluated BIGINT, delayed BIGINT, auc_roc DOUBLE").alias("m"),
        F.from_json("confusion", "ARRAY<STRUCT<is_delayed: BOOLEAN, flights: BIGINT>>").alias("c"),
        F.from_json("importances", "MAP<STRING, DOUBLE>").alias("i"),
    )
    return run.selectExpr(
        "model_version", "m.evaluated", "m.delayed",
        "aggregate(c, 0L, (n, x) -> n + x.flights) AS matrix_flights",
        "aggregate(c, 0L, (n, x) -> n + if(x.is_delayed, x.flights, 0L)) AS matrix_delayed",
        "size(i) AS features",
        "abs(aggregate(map_values(i), 0D, (n, x) -> n + x) - 1) < 1e-6 AS importances_sum_to_one",
        f"m.auc_roc > {LEAST_AREA} AS learns",
    )


@query
def prediction_checks(spark, sf_dir):
    """Every clean flight is scored once, and its flag follows from its probability."""
    tables = _trained(spark, sf_dir)
    model.run_inference(tables)
    chance = F.col("delay_probability")
    return tables.read("gold.ml_predictions").groupBy("flight_date", "model_version").agg(
        F.count("*").alias("flights"),
        F.count_if(chance.between(0, 1)).alias("probabilities"),
        F.count_if(F.col("predicted_delayed") == (chance >= 0.5)).alias("flags_that_follow"),
    )


@query
def predictions(spark, sf_dir):
    tables = _trained(spark, sf_dir)
    model.run_inference(tables)
    return conform(tables.read("gold.ml_predictions"), contract("gold.ml_predictions").schema).drop(
        "prediction_timestamp"
    )


@query
def baseline_area(spark, sf_dir):
    """How well the trailing late share of a route orders late flights before others."""
    return evaluation.rank_sums(_baseline(spark, sf_dir))


@query
def drift_ks(spark, sf_dir):
    rows = add_temporal(valid(spark, sf_dir)).select(
        "flight_date", "departure_delay_minutes", "arrival_delay_minutes", "distance_miles", "dep_hour")
    current = F.col("flight_date") >= F.lit(DRIFT_START).cast("date")
    return monitoring.distribution_distance(rows, current, rows.columns[1:])


@query
def late_label_alarms(spark, sf_dir):
    """Predictions are one table, labels another that arrives days later, a carrier after the other."""
    flights = _clean(spark, sf_dir)
    predictions = stage_table(_scored(flights).select(*FLIGHT_KEY, "predicted_delayed"), "predictions")
    known_on = F.date_add("flight_date", 1 + F.coalesce(F.ascii("reporting_airline"), F.lit(0)) % 7)
    labels = stage_table(flights.select(
        *FLIGHT_KEY, delay_label(F.col("arrival_delay_minutes")).alias("is_delayed"), known_on.alias("known_on")), "labels")
    return monitoring.error_alarms(predictions, labels, tolerated_permille=150, trigger=5_000, quiet_days=30)


IMPORTANCE_FEATURES = ("departure_delay_minutes", "dep_hour", "distance_miles", "constant")


def _rule(flights: DataFrame) -> DataFrame:
    """A scorer without training: late departures, evenings and long ways."""
    points = (F.coalesce("departure_delay_minutes", F.lit(0)) + F.when(F.col("dep_hour") >= 17, 10).otherwise(0)
              + F.when(F.col("distance_miles") > 1000, 5).otherwise(0))
    return flights.withColumn("predicted_delayed", points >= 15)


@query
def rule_importance(spark, sf_dir):
    """How much accuracy a rule owes to each of its features."""
    flights = add_temporal(valid(spark, sf_dir).where("arrival_delay_minutes IS NOT NULL")).withColumns({
        "is_delayed": delay_label(F.col("arrival_delay_minutes")), "constant": F.lit(1)})
    key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("?")) for c in FLIGHT_KEY])
    return permutation_importance(flights, IMPORTANCE_FEATURES, _rule, key=key, seed=7)


LEAF_BINS = (
    leaf_trees.Bins("departure_delay_minutes", (-5.0, 0.0, 5.0, 10.0, 15.0, 30.0, 60.0)),
    leaf_trees.Bins("dep_hour", (6.0, 9.0, 12.0, 15.0, 18.0, 21.0)),
    leaf_trees.Bins("distance_miles", (250.0, 500.0, 1000.0, 1500.0, 2000.0)),
    leaf_trees.Bins("season", values=("winter", "spring", "summer", "autumn")),
)


@query
def leaf_splits(spark, sf_dir):
    """Splits and leaves of two boosted trees over all clean flights, grown leaf by leaf."""
    flights = add_temporal(valid(spark, sf_dir)).withColumn("late", delay_label(F.col("arrival_delay_minutes")))
    return leaf_trees.fit(
        flights, LEAF_BINS, label="late", trees=2, num_leaves=5, learning_rate=0.3, least_rows=5,
    ).table(spark)


_LEAF_PARAMS = model.Params(learning_rate=0.2, n_estimators=5, num_leaves=12)


@query
def leaf_run_checks(spark, sf_dir):
    """A registered run of trees grown by leaves: its parameters, its data set's version and its model as the registry
    has them, and what must hold of its results."""
    features = _trained(spark, sf_dir).read("gold.ml_features")
    registry = model.Registry(Tables(spark, scratch_path(spark, "tables")))
    registry.register(model.train(features, _LEAF_PARAMS, tags={"dataset_version": dataset_version(features)}))
    kept, version = registry.load()
    leaves = kept.table(spark).where("feature IS NULL").groupBy("tree").count().agg(F.max("count").alias("most_leaves"))
    run = registry.tables.read("gold.model_runs").where(F.col("model_version") == version).select(
        "model_version",
        F.from_json("params", "num_leaves INT, n_estimators INT, learning_rate DOUBLE").alias("p"),
        F.from_json("tags", "dataset_version STRING").alias("t"),
        F.from_json("metrics", "evaluated BIGINT, delayed BIGINT, auc_roc DOUBLE").alias("m"),
        F.from_json("confusion", "ARRAY<STRUCT<is_delayed: BOOLEAN, flights: BIGINT>>").alias("c"),
        F.from_json("importances", "MAP<STRING, DOUBLE>").alias("i"),
    )
    return run.join(leaves).selectExpr(
        "model_version", "p.*", "CAST(split_part(t.dataset_version, '-', 1) AS BIGINT) AS dataset_rows",
        "m.evaluated", "m.delayed", "aggregate(c, 0L, (n, x) -> n + x.flights) AS matrix_flights",
        "size(i) AS features", "abs(aggregate(map_values(i), 0D, (n, x) -> n + x) - 1) < 1e-6 AS importances_sum_to_one",
        "most_leaves <= p.num_leaves AS leaves_within", f"m.auc_roc > {LEAST_AREA} AS learns",
    )
