"""Drift, prediction trends, retraining decision and data expectations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.operators.evaluation import LABEL, PREDICTED, PROBABILITY
from skyledger.operators.flights import FLIGHT_KEY
from skyledger.operators.prefix import running_totals

SMALLEST_SHARE = 0.0001  # stands for an empty bin, so that its logarithm exists
DRIFT_LIMIT = 0.2


def _shares(df: DataFrame, current: Column, bins: Mapping[str, Column]) -> DataFrame:
    """Per feature and bin: the share of the reference rows and of the current rows.

    All features in one scan; the rows are unfolded per feature but counted before the
    shuffle, which carries one row per task, feature and bin. The window runs over the bins.
    """
    flagged = df.select(current.alias("_current"), *[c.cast("string").alias(n) for n, c in bins.items()])
    counted = (
        flagged.unpivot("_current", list(bins), "feature", "bin")
        .groupBy("feature", "bin")
        .agg(F.count_if(~F.col("_current")).alias("before"), F.count_if("_current").alias("now"))
    )
    whole = Window.partitionBy("feature")
    return counted.select(
        "feature", "bin",
        F.try_divide("before", F.sum("before").over(whole)).alias("p"),
        F.try_divide("now", F.sum("now").over(whole)).alias("q"),
    )


def _equal_bins(df: DataFrame, features: Sequence[str], bins: int) -> dict[str, Column]:
    """The bin of each feature, of equal width over the range it has in ``df``."""
    if not features:
        return {}
    ends = df.agg(*[
        end for name in features
        for end in (F.min(F.col(name).cast("double")).alias(f"low_{name}"),
                    F.max(F.col(name).cast("double")).alias(f"high_{name}"))
    ]).first()

    def bin_of(name: str) -> Column:
        low, high = ends[f"low_{name}"], ends[f"high_{name}"]
        value = F.col(name).cast("double")
        if low is None or low == high:
            return F.when(value.isNull(), -1).otherwise(0)
        place = F.floor((value - low) / (high - low) * bins)
        return F.when(value.isNull(), -1).otherwise(
            F.greatest(F.lit(0), F.least(F.lit(bins - 1), place))
        )

    return {name: bin_of(name) for name in features}


def drift(
    df: DataFrame, current: Column, numbers: Sequence[str] = (), texts: Sequence[str] = (), *,
    bins: int = 10, limit: float = DRIFT_LIMIT,
) -> DataFrame:
    """One row per feature: the population stability index of a number, the total variation
    distance (half the sum of share differences) of a text.

    ``current`` tells current rows from reference rows. Bins are of equal width over the
    range of the reference; values beyond it fall in the outer bins, NULL in its own. Two
    passes over the rows: the ranges of the numbers, and the counts of all features.
    """
    binned = _equal_bins(df.filter(~current), numbers, bins)
    shares = _shares(df, current, {**binned, **{name: F.col(name) for name in texts}})
    is_number = F.col("feature").isin(list(numbers))
    p = F.greatest("p", F.lit(SMALLEST_SHARE))
    q = F.greatest("q", F.lit(SMALLEST_SHARE))
    step = F.when(is_number, (q - p) * F.ln(q / p)).otherwise(F.abs(F.col("q") - F.col("p")))
    return shares.groupBy("feature").agg(_sum(step).alias("total")).select(
        "feature",
        F.when(is_number, "psi").otherwise("variation").alias("measure"),
        F.round(F.when(is_number, F.col("total")).otherwise(F.col("total") / 2), 6).alias("distance"),
    ).withColumn("drifted", F.col("distance") > limit)


def numeric_drift(
    df: DataFrame, current: Column, features: Sequence[str], *, bins: int = 10,
    limit: float = DRIFT_LIMIT,
) -> DataFrame:
    return drift(df, current, numbers=features, bins=bins, limit=limit)


def categorical_drift(
    df: DataFrame, current: Column, features: Sequence[str], *, limit: float = DRIFT_LIMIT
) -> DataFrame:
    return drift(df, current, texts=features, limit=limit)


def distribution_distance(df: DataFrame, current: Column, numbers: Sequence[str]) -> DataFrame:
    """One row per number: the two-sample Kolmogorov-Smirnov distance between reference and current rows,
    without bins: the largest difference of their cumulative shares at any value. NULLs are left out; the
    distance is NULL unless both sides have values. One running total over the distinct values."""
    values = df.select(current.alias("_current"), F.explode(F.array(*[
        F.struct(F.lit(n).alias("feature"), F.col(n).cast("double").alias("value")) for n in numbers
    ])).alias("v")).select("_current", "v.*").where("value is not null")
    levels = values.groupBy("feature", "value").agg(
        F.count_if(~F.col("_current")).alias("before"), F.count_if("_current").alias("now"))
    running = running_totals(levels, ["feature", "value"], ["before", "now"])
    # A feature's own totals begin where the running ones stand at its least value. Both come from the written
    # levels: the rows are not read again.
    spans = running.groupBy("feature").agg(
        F.sum("before").alias("n_before"), F.sum("now").alias("n_now"),
        F.min("before_before").alias("b0"), F.min("before_now").alias("n0"))
    wide = lambda c: F.expr(c).cast("decimal(19,0)")
    apart = F.abs(wide("before_before + before - b0") * wide("n_now") - wide("before_now + now - n0") * wide("n_before"))
    return running.join(spans, "feature").groupBy("feature", "n_before", "n_now").agg(
        F.max(apart).alias("_apart")
    ).select(
        "feature", F.col("n_before").alias("reference_rows"), F.col("n_now").alias("current_rows"),
        F.try_divide(F.col("_apart").cast("double"), (wide("n_before") * wide("n_now")).cast("double")).alias("distance"),
    )


def _judged(predictions: DataFrame, labels: DataFrame, *more: str) -> DataFrame:
    """Predictions beside the labels of their flights, NULLs of the key matching (a carrier may be unknown).
    A hash of the key is compared first, so that the sorts of a merge seldom look at the key itself."""
    theirs = [f"_{c}" for c in FLIGHT_KEY]
    known = labels.select(*[F.col(c).alias(t) for c, t in zip(FLIGHT_KEY, theirs)], LABEL, *more)
    same = [F.col(c).eqNullSafe(F.col(t)) for c, t in zip(FLIGHT_KEY, theirs)]
    return predictions.select(*FLIGHT_KEY, PREDICTED).join(known, [F.xxhash64(*FLIGHT_KEY) == F.xxhash64(*theirs), *same])


def error_alarms(
    predictions: DataFrame, labels: DataFrame, *, tolerated_permille: int, trigger: int, quiet_days: int
) -> DataFrame:
    """One row per day on which labels became known: how many predictions they judge, how many were wrong,
    the detector's statistic and whether it calls for retraining.

    ``labels`` come later than predictions and carry ``known_on``. The detector sums, day after day, a
    thousand times the errors less the tolerated ones, never below 0. Above ``trigger`` it raises an
    alarm, starts again from 0 and rests for ``quiet_days``. It folds one row a day, so what is gathered
    grows with the calendar, not with the flights.
    """
    daily = _judged(predictions, labels, "known_on").groupBy("known_on").agg(
        F.count("*").alias("evaluated"), F.count_if(F.col(PREDICTED) != F.col(LABEL)).alias("errors"))
    days = daily.agg(F.array_sort(F.collect_list(F.struct("known_on", "evaluated", "errors"))).alias("days"))

    def step(state: Column, day: Column) -> Column:
        excess = day["errors"] * 1000 - day["evaluated"] * tolerated_permille
        resting = F.coalesce(F.datediff(day["known_on"], state["alarm_on"]) <= quiet_days, F.lit(False))
        grown = F.when(resting, F.lit(0).cast("bigint")).otherwise(F.greatest(F.lit(0), state["statistic"] + excess))
        alarm = grown > trigger
        row = F.struct(day["known_on"].alias("known_on"), day["evaluated"].alias("evaluated"), day["errors"].alias("errors"),
                       grown.alias("statistic"), alarm.alias("retrain"))
        return F.struct(
            F.when(alarm, F.lit(0).cast("bigint")).otherwise(grown).alias("statistic"),
            F.when(alarm, day["known_on"]).otherwise(state["alarm_on"]).alias("alarm_on"),
            F.concat(state["rows"], F.array(row)).alias("rows"),
        )

    rows = "array<struct<known_on: date, evaluated: bigint, errors: bigint, statistic: bigint, retrain: boolean>>"
    start = F.struct(F.lit(0).cast("bigint").alias("statistic"), F.lit(None).cast("date").alias("alarm_on"),
                     F.array().cast(rows).alias("rows"))
    return days.select(F.explode(F.aggregate("days", start, step, lambda s: s["rows"])).alias("r")).select("r.*")


def _mean(value: Column) -> Column:
    """The mean of a share, each rounded to its twelfth decimal: the sum is of integers, so its order
    does not matter."""
    trillionths = F.sum(F.floor(value * 1e12 + 0.5).cast("decimal(20,0)"))
    return F.try_divide(trillionths.cast("double"), F.count(value) * F.lit(1e12))


def _sum(value: Column) -> Column:
    """A sum of doubles in integers of 1e-12, whatever the order."""
    return F.sum(F.round(value * 1e12).cast("bigint")) / 1e12


def _prediction_summary(predictions: DataFrame, key: str) -> DataFrame:
    return predictions.groupBy(key).agg(
        F.count("*").alias("flights"),
        _mean(F.col(PROBABILITY)).alias("avg_delay_probability"),
        F.count_if(PREDICTED).alias("predicted_delayed_flights"),
    )


def prediction_trend(predictions: DataFrame) -> DataFrame:
    return _prediction_summary(predictions, "flight_date")


def route_probability(predictions: DataFrame) -> DataFrame:
    return _prediction_summary(predictions, "route_code")


def retrain_decision(
    predictions: DataFrame, labels: DataFrame, *, min_accuracy: float
) -> DataFrame:
    """One row: accuracy of the predictions whose label is known by now, and whether it
    calls for a new training run."""
    counted = _judged(predictions, labels).agg(
        F.count("*").alias("evaluated"),
        F.count_if(F.col(PREDICTED) == F.col(LABEL)).alias("correct"),
    )
    accuracy = F.try_divide("correct", "evaluated")
    return counted.select(
        "evaluated", "correct", accuracy.alias("accuracy"),
        F.lit(min_accuracy).alias("min_accuracy"),
        F.coalesce(accuracy < min_accuracy, F.lit(False)).alias("retrain"),
    )


def check_expectations(
    df: DataFrame, expectations: Mapping[str, str], *, tolerated_share: float = 0.0
) -> DataFrame:
    """Evaluate SQL conditions over all rows in one pass: one result row per condition.

    A condition that is NULL for a row counts as violated.
    """
    failed = {
        name: F.count_if(~F.coalesce(F.expr(text), F.lit(False))) for name, text in expectations.items()
    }
    counts = df.agg(F.count("*").alias("_rows"), *[c.alias(name) for name, c in failed.items()])
    return (
        counts.unpivot("_rows", list(expectations), "expectation", "failed_rows")
        .select(
            "expectation",
            F.col("_rows").alias("checked_rows"),
            "failed_rows",
            (F.col("failed_rows") <= F.col("_rows") * tolerated_share).alias("passed"),
        )
    )
