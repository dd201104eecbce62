"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z, and nothing else, in lower case."""
    return F.translate(text, _UPPER, _UPPER.lower())


def narrow(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the named columns: whatever else the input has cannot clash with an operator's own."""
    return df.select(*[F.col(f"`{name}`") for name in columns])


def top_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str) -> DataFrame:
    """The first ``k`` rows of each key. Spark limits each key on the map side first, so a
    hot key sends ``k`` rows per task."""
    from pyspark.sql import Window

    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)
