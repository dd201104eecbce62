"""What a scorer loses when one of its features is shuffled."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def permutation_importance(
    rows: DataFrame,
    features: Sequence[str],
    score: Callable[[DataFrame], DataFrame],
    *,
    key: Column,
    label: str = "is_delayed",
    predicted: str = "predicted_delayed",
    seed: int = 0,
    block_digits: int = 2,
) -> DataFrame:
    """A row per feature: rows, how many the scorer gets right as they are and with the feature permuted, and
    the loss of accuracy.

    ``score`` adds ``predicted`` to rows that have ``features``. ``key``, a text, tells rows apart.
    Rows fall into 16 ** ``block_digits`` blocks by a hash of it, so one shuffle serves all features and no
    order spans all rows; raise it with the data, so that a block stays within a task. Within a block each
    feature has a hash order of its own, in which every row takes the value of the next one and the last row
    that of the first: the same permutation whatever the partitions. A row alone in its block keeps its
    values. Rows without a label are left out; a missing prediction is a wrong one.
    """
    right = F.coalesce(F.col(predicted) == F.col("_label"), F.lit(False)).cast("bigint")
    digest = lambda salt: F.md5(F.concat(F.lit(f"{seed}/{salt}/"), F.col("_key")))
    told = rows.where(F.col(label).isNotNull()).select(*features, key.alias("_key"), F.col(label).alias("_label"))
    judged = score(told).select(
        *features, "_key", "_label", right.alias("_right"), F.substring(digest(""), 1, block_digits).alias("_block"))
    moved = {}
    for name in features:
        order = Window.partitionBy("_block").orderBy(digest(name))
        last = F.lead(F.lit(1)).over(order).isNull()
        moved[name] = F.when(last, F.first(name).over(order)).otherwise(F.lead(name).over(order))
    shuffled = judged.withColumns({f"_moved_{name}": value for name, value in moved.items()})
    variants = F.array(*[
        F.struct(F.lit(name).alias("feature"),
                 *[F.col(f"_moved_{other}" if other == name else other).alias(other) for other in features])
        for name in features
    ])
    each = shuffled.select("_label", "_right", F.inline(variants))
    summed = score(each).groupBy("feature").agg(
        F.count("*").alias("rows"), F.sum("_right").alias("correct"), F.sum(right).alias("correct_permuted"))
    return summed.withColumn("importance", F.try_divide(F.col("correct") - F.col("correct_permuted"), F.col("rows")))
