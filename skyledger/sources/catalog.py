"""Tables of Spark's own catalog: Parquet, partitioned by a slice column, readable by name and from SQL.

Reruns replace whole slices by dynamic partition overwrite, which leaves the files of the others alone. There
are no versions and no log here: what a name holds is what its partitions hold.
"""

from __future__ import annotations

from collections.abc import Iterable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_MODE = "spark.sql.sources.partitionOverwriteMode"


class CatalogTable:
    """One table of the session catalog."""

    def __init__(self, spark: SparkSession, name: str, slice_by: str):
        self.spark, self.name, self.slice_by = spark, name, slice_by

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def create(self, schema: StructType | str) -> CatalogTable:
        """Create the table unless it is there. The slice column comes last, as Spark stores it."""
        if not self.exists():
            self.spark.createDataFrame([], schema).write.format("parquet").partitionBy(self.slice_by).saveAsTable(self.name)
        return self

    def read(self, slices: Iterable[str] | None = None) -> DataFrame:
        """The table, or some of its slices; Spark lists only these."""
        if not self.exists():
            raise LookupError(f"table '{self.name}' does not exist")
        rows = self.spark.table(self.name)
        return rows if slices is None else rows.where(F.col(self.slice_by).isin(list(slices)))

    def _placed(self, df: DataFrame) -> DataFrame:
        """Columns by name in the table's order; small slices share a task, a large one is split."""
        return df.select(*self.read().columns).hint("rebalance", self.slice_by)

    @contextmanager
    def _overwrite_mode(self, mode: str):
        before = self.spark.conf.get(_MODE, None)
        self.spark.conf.set(_MODE, mode)
        try:
            yield
        finally:
            self.spark.conf.unset(_MODE) if before is None else self.spark.conf.set(_MODE, before)

    def append(self, df: DataFrame) -> None:
        self._placed(df).write.insertInto(self.name)

    def overwrite(self, df: DataFrame) -> None:
        """All rows of the table become those of ``df``."""
        with self._overwrite_mode("static"):
            self._placed(df).write.insertInto(self.name, overwrite=True)

    def replace_slices(self, df: DataFrame, slices: Iterable[str] | None = None) -> None:
        """The slices that ``df`` has rows of, and those named that it has none of, become those of ``df``.
        A rerun with the same rows changes nothing."""
        with self._overwrite_mode("dynamic"):
            self._placed(df).write.insertInto(self.name, overwrite=True)
        if slices is not None:  # as many values as slices were named
            wanted = list(slices)
            there = {r[0] for r in df.where(F.col(self.slice_by).isin(wanted)).select(self.slice_by).distinct().collect()}
            self.drop_slices(set(wanted) - there)

    def drop_slices(self, slices: Iterable[str]) -> None:
        for value in slices:
            text = str(value).replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({self.slice_by} = '{text}')")

    def insert_columns(self, df: DataFrame) -> None:
        """Insert by a column list: columns that ``df`` does not have take their default, NULL if there is none."""
        listed = ", ".join(f"`{c}`" for c in df.columns)
        self.spark.sql(f"INSERT INTO {self.name} ({listed}) SELECT {listed} FROM {{rows}}", rows=df)
