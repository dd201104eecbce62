"""CSV files as a stream of rows into catalog tables.

The stream carries rows, not file names: types, rescue and lineage are part of its plan. Each micro-batch is
written once below the shared folder and from there replaces its own slice of both tables, so a micro-batch
that is repeated after a failure changes nothing. Counts are observed by that write.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from skyledger.functions.casting import quoted
from skyledger.operators.lineage import derive_missing, enrich
from skyledger.operators.rescue import PAYLOAD_COLUMN, rejected_records, type_and_rescue
from skyledger.session import scratch, work_dir
from skyledger.sources.catalog import CatalogTable
from skyledger.sources.datasets import DatasetSpec

FILES_PER_BATCH = 10_000  # what one micro-batch takes on at most; the rest comes with the next


def typed_stream(spark: SparkSession, spec: DatasetSpec, schema: T.StructType, header: Sequence[str],
                 files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Rows of the files as they land, typed, with misfits noted.

    ``header`` names the columns of the files in their order; a file with other names fails its
    micro-batch instead of filling wrong columns. Columns that ``schema`` does not have are rescued.
    """
    fields = [T.StructField(name, T.StringType()) for name in (*header, "_malformed")]
    lines = (
        spark.readStream.schema(T.StructType(fields))
        .options(**{k: v for k, v in spec.options.items() if k not in ("header", "inferSchema")})
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_malformed")
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(spec.source_path)
    )
    unknown = [name for name in header if name not in schema.names]
    source = lines.select(
        *[quoted(name) if name in header else F.lit(None).cast("string").alias(name) for name in schema.names],
        *[quoted(name) for name in unknown],
        F.expr("CAST(NULL AS MAP<STRING, STRING>)").alias("_unknown"),
        "_malformed",
        F.col("_metadata.file_name").alias("_file"),
    )
    typed = type_and_rescue(source, schema, unknown=unknown, rescued_column=spec.rescued_column)
    traced = enrich(typed, file_name=F.col("_file"), source_system=spec.source_system)
    return derive_missing(traced)


def publish_batch(spec: DatasetSpec, rows: DataFrame, batch_id: str, slice_by: str = "batch_id") -> dict:
    """Make ``rows`` the slice ``batch_id`` of the target, and the misfits that of the rejected table. Returns
    how many rows went where."""
    spark = rows.sparkSession  # that of the micro-batch: its settings count for the writes
    target = CatalogTable(spark, spec.target_table, slice_by)
    rejects = CatalogTable(spark, spec.rejected_table, slice_by)
    misfit = F.col(spec.rescued_column).isNotNull()
    seen = Observation()
    with scratch(spark) as stage:
        written = stage(
            rows.withColumn("batch_id", F.lit(batch_id)).observe(
                seen, F.count_if(~misfit).alias("rows_written"), F.count_if(misfit).alias("rows_rescued")),
            "micro-batch")
        target.replace_slices(written.where(~misfit).drop(spec.rescued_column, PAYLOAD_COLUMN), [batch_id])
        rejects.replace_slices(
            rejected_records(written.where(misfit), source_table=spec.target_table,
                             source_system=spec.source_system, rescued_column=spec.rescued_column), [batch_id])
    return {"batch_id": batch_id, **seen.get}


def stream_rows(
    spark: SparkSession,
    spec: DatasetSpec,
    header: Sequence[str],
    *,
    stream: str,
    checkpoint: str | None = None,
    files_per_batch: int = FILES_PER_BATCH,
    report: Callable[[dict], None] | None = None,
) -> StreamingQuery:
    """Start a query that takes on every file not yet taken, then stops. Both tables of ``spec`` are catalog
    tables that exist; ``report`` gets the counts of each micro-batch."""

    def take(batch: DataFrame, epoch: int) -> None:
        counts = publish_batch(spec, batch, f"{stream}-{epoch}")
        for name in (spec.target_table, spec.rejected_table):
            spark.catalog.refreshTable(name)  # the micro-batch wrote in a session of its own
        if report is not None:
            report(counts)

    typed = typed_stream(spark, spec, spark.table(spec.target_table).schema, header, files_per_batch)
    return (
        typed.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint or f"{work_dir(spark)}/streams/{stream}")
        .trigger(availableNow=True)
        .start()
    )
