"""Logs: tables that rows are only added to, as plain Parquet files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.contracts import Contract
from skyledger.sources.storage import Storage

_MARK = "_log"  # says that the log exists; Spark does not read it


class LogTable:
    """Each writer appends to a folder of its own below the log, so that writers at the same time
    do not meet; a reader sees the folders of all of them."""

    def __init__(self, spark: SparkSession, root: str, table: Contract):
        self.spark = spark
        self.contract = table
        self.name = table.name
        self.path = f"{root.rstrip('/')}/{table.name.replace('.', '/')}"
        self._storage = Storage(spark)

    def exists(self) -> bool:
        return _MARK in self._storage.names(self.path)

    def create(self) -> LogTable:
        """Create the log, empty, unless it exists."""
        if not self.exists():
            self._storage.create(f"{self.path}/{_MARK}", "")
        return self

    def append_rows(self, rows: Sequence[tuple], writer: str) -> None:
        """Add a few rows made on the driver."""
        frame = self.spark.createDataFrame(list(rows), self.contract.schema).coalesce(1)
        frame.write.mode("append").parquet(f"{self.path}/writer={writer}")

    def read(self) -> DataFrame:
        if not any(name.startswith("writer=") for name in self._storage.names(self.path)):
            return self.spark.createDataFrame([], self.contract.schema)
        return self.spark.read.schema(self.contract.schema).parquet(self.path).select(
            *[F.col(name) for name in self.contract.schema.names])
