"""Incremental ingestion of newly landed files.

The stream watches the landing directory and carries file names; each micro-batch reads
its files with the batch reader, so drift is handled as in a batch run. The checkpoint
remembers which files were taken, and the batch id is made from the stream's name and
the micro-batch number: a micro-batch that is repeated after a failure replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from skyledger.plans.bronze import ingest
from skyledger.session import work_dir
from skyledger.sources.datasets import DatasetSpec
from skyledger.sources.snapshots import Tables

FILES_PER_BATCH = 10_000  # bounds the list of names one micro-batch brings to the driver


def ingest_stream(
    tables: Tables,
    spec: DatasetSpec,
    *,
    stream: str,
    checkpoint: str | None = None,
    files_per_batch: int = FILES_PER_BATCH,
    glob: str = "*",
) -> StreamingQuery:
    """Start a query that ingests every file not yet taken, then stops."""
    tables.table(spec.target_table).create()

    def take(batch: DataFrame, epoch: int) -> None:
        names = [row["path"] for row in batch.select("path").collect()]
        if names:
            ingest(tables, spec, batch_id=f"{stream}-{epoch}", files=sorted(names))

    landed = (
        tables.spark.readStream.format("binaryFile")
        .schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(spec.source_path)
        .select("path")
    )
    return (
        landed.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint or f"{work_dir(tables.spark)}/streams/{stream}")
        .trigger(availableNow=True)
        .start()
    )
