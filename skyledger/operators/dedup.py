"""Deterministic deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.session import LARGE_BYTES, scanned_bytes, stage_table

#: So many hashes of repeated keys are broadcast, 8 bytes each and as much again for the table around them.
MOST_REPEATED = 2_000_000

LATEST_INGESTED = ("ingestion_timestamp", "record_hash")


def latest_per_key(
    df: DataFrame, key: Sequence[str | Column], latest: Sequence[str] = LATEST_INGESTED
) -> DataFrame:
    """One row per key: the one with the highest values of ``latest``, NULLs last.

    The rank filter makes Spark limit every key to one row per map task before the
    shuffle, so a hot key (or a NULL key) never gathers its rows in one task.
    """
    newest_first = [F.col(c).desc_nulls_last() for c in latest]
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*newest_first))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def split_repeated(df: DataFrame, key: Sequence[str | Column]) -> tuple[DataFrame | None, DataFrame]:
    """(rows whose key no other row has, the others): the first need no comparison, and so no shuffle.

    Eight bytes a row are shuffled to find the hashes that come more than once. These are written, and the rows are read
    again and split by them; keys that share a hash are all among the others. A small table, a stream and one with
    more than ``MOST_REPEATED`` such hashes are not split: the first frame is None.
    """
    if df.isStreaming or scanned_bytes(df) < LARGE_BYTES:
        return None, df
    hashed = df.withColumn("_key_hash", F.xxhash64(*key))
    counted = hashed.groupBy("_key_hash").agg(F.count("*").alias("n"))
    repeated = stage_table(counted.where("n > 1").select("_key_hash"), "repeated_keys")
    if repeated.count() > MOST_REPEATED:
        return None, df
    repeated = F.broadcast(repeated)
    once, others = (hashed.join(repeated, "_key_hash", how).drop("_key_hash") for how in ("left_anti", "left_semi"))
    return once, others
