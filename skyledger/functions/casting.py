"""Tolerant casts and projections onto a fixed schema."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def whole_minutes(col: Column) -> Column:
    """A measure in minutes as INT, truncated toward zero; NaN and text become NULL."""
    return col.try_cast("double").try_cast("int")


def is_blank(col: Column) -> Column:
    return col.isNull() | (F.trim(col) == "")


def kept_whole(col: Column) -> Column:
    """The same value, in an expression that Spark does not repeat: a filter on it stays above the projection, in place
    of being pushed below it with a copy of all that the column is made from."""
    return F.when(F.monotonically_increasing_id() >= 0, col)


def missing_fields(schema: T.StructType, known: Iterable[str]) -> list[T.StructField]:
    """Fields of ``schema`` whose names are not in ``known``, in order."""
    known = set(known)
    return [f for f in schema.fields if f.name not in known]


def quoted(name: str) -> Column:
    """A column by its exact name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def conform(df: DataFrame, schema: T.StructType, skip: Iterable[str] = ()) -> DataFrame:
    """Project ``df`` onto ``schema``.

    Every target column is cast to its type, a column the input lacks becomes NULL, and
    columns the target does not know are dropped. Names in ``skip`` are left out. Values
    that do not fit become NULL instead of failing the job.
    """
    skip, have = set(skip), dict(df.dtypes)

    def target(field: T.StructField) -> Column:
        if field.name not in have:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if have[field.name] == field.dataType.simpleString():
            return quoted(field.name)
        return quoted(field.name).try_cast(field.dataType).alias(field.name)

    return df.select([target(f) for f in schema.fields if f.name not in skip])


def surrogate_key(key: Iterable[str]) -> Column:
    """A reproducible BIGINT key: 64-bit hash of the business key, NULL-safe."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in key])
