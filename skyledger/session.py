"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.sources.storage import Storage

_INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_SCAN_BYTES = "spark.sql.files.maxPartitionBytes"
_local_dirs: dict[str, str] = {}

#: From so many bytes of files on, a job spends passes over its rows to keep wide ones out of shuffles.
LARGE_BYTES = 64 << 20
MODEST = 8
_UNKNOWN_BYTES = 1 << 60  # what Spark takes for a leaf without statistics is above


# Settings the jobs rely on. The method limit keeps generated code within what the JVM
# compiles: the wide projections here would otherwise run interpreted, several times slower.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session built elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "skyledger", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs expect. Extra settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**SETTINGS, **{key: str(value) for key, value in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The folder all executors share.

    The cluster names it in ``spark.checkpoint.dir``. A local session that does not
    set it gets a temporary folder; on a cluster its absence is an error, because a
    folder of one machine is not visible to the others.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if shared:
        return shared.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # local-cluster has machines of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="skyledger-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stage_table(df: DataFrame, name: str, root: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several consumers need the same expensive result. Unlike a cached
    frame it survives lost executors, and because it is a file source Spark knows its
    real size when it picks join strategies. Shuffle files of a large one go with the write.
    """
    spark = df.sparkSession
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}" if root else scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    if scanned_bytes(df) >= LARGE_BYTES:
        release_shuffles(spark)
    return spark.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished writes. Its cleaner acts when the driver collects the plans
    that made them, which a driver with memory to spare puts off while the files of one step after another stay."""
    spark.sparkContext._jvm.System.gc()


def scanned_bytes(df: DataFrame) -> int:
    """Bytes of the files and local rows that ``df`` is made from, each before any join. Leaves of unknown size
    count as none."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(size for size in sizes if size < _UNKNOWN_BYTES)


def broadcast_if_modest(lookup: DataFrame) -> DataFrame:
    """A written lookup, marked for broadcast up to ``MODEST`` times the size to which Spark broadcasts by itself: what
    it spares is a shuffle and a sort of the many rows that meet it."""
    limit = lookup.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    staged = lookup._jdf.queryExecution().analyzed().children().isEmpty()  # only then is its size the one that counts
    return F.broadcast(lookup) if staged and scanned_bytes(lookup) <= MODEST * limit else lookup


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A ``stage_table`` whose tables are removed at the end of the block."""
    root = scratch_path(spark, "scratch")
    try:
        yield lambda df, name: stage_table(df, name, root)
    finally:
        Storage(spark).remove(root)


def fit_shuffles(scan: DataFrame, *, task_bytes: int = 16 << 20) -> int:
    """Start shuffles with enough partitions for the files of ``scan``, and deal its files in small shares.

    Adaptive execution merges small partitions but never adds any, so the number to start
    from has to grow with the data: one per ``task_bytes`` of Parquet (20 to 40 times that
    in memory, less than a task's share). Never below ``spark.sql.shuffle.partitions``. Where every core
    has several such shares to read, scans deal no larger ones: what a task sorts, or a training run caches
    (some 11 times the Parquet), stays as small however large the table is.
    """
    spark = scan.sparkSession
    size = scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    wanted = -(-int(str(size)) // task_bytes)
    partitions = max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set(_INITIAL_PARTITIONS, str(partitions))
    usual = spark.sparkContext.getConf().get(_SCAN_BYTES, "128MB")
    spark.conf.set(_SCAN_BYTES, str(task_bytes) if wanted > 2 * spark.sparkContext.defaultParallelism else usual)
    return partitions
