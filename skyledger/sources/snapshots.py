"""Versioned tables: Parquet files plus one small JSON document per version.

Every write goes to a directory of its own, ``data/run=<id>/snapshot__slice=<value>``. A version
lists the directories that make up the table; publishing creates the document of the next
version and fails if it exists. A failed write leaves files no version refers to, a
rerun replaces only the slices it contains, and restoring is publishing an old list again.
One writer per table at a time.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.contracts import CONTRACTS, Contract, contract
from skyledger.functions.casting import conform, missing_fields, surrogate_key
from skyledger.operators.dedup import latest_per_key
from skyledger.session import release_shuffles, scratch
from skyledger.sources.logs import LogTable
from skyledger.sources.storage import Storage

_NULL_DIRECTORY = "__HIVE_DEFAULT_PARTITION__"
_VERSION_SCHEMA = (
    "version BIGINT, operation STRING, committed_at TIMESTAMP, rows_written BIGINT,"
    " rows_removed BIGINT"
)


class MissingTable(LookupError):
    """The table was never created."""


# Partition columns of the written files: not names that data has.
_LANE, _SLICE = "snapshot__lane", "snapshot__slice"


class CommitConflict(RuntimeError):
    """Another writer has published the version."""


@dataclass(frozen=True)
class Slice:
    value: str | None
    directory: str
    rows: int


@dataclass(frozen=True)
class Version:
    number: int
    operation: str
    schema: T.StructType
    slices: tuple[Slice, ...] = ()
    rows_written: int = 0
    rows_removed: int = 0

    def to_json(self) -> str:
        return json.dumps({
            "version": self.number,
            "operation": self.operation,
            "committed_at": datetime.now(timezone.utc).isoformat(),
            "rows_written": self.rows_written,
            "rows_removed": self.rows_removed,
            "schema": self.schema.jsonValue(),
            "slices": [vars(s) for s in self.slices],
        })

    @staticmethod
    def from_json(text: str) -> Version:
        doc = json.loads(text)
        return Version(
            doc["version"], doc["operation"], T.StructType.fromJson(doc["schema"]),
            tuple(Slice(**s) for s in doc["slices"]), doc["rows_written"], doc["rows_removed"],
        )


@dataclass(frozen=True)
class Run:
    """Files that were written but are not part of any version yet."""

    schema: T.StructType
    slices: tuple[Slice, ...]
    set_aside: tuple[Slice, ...] = ()
    values: frozenset = field(default_factory=frozenset)


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str, table: Contract):
        self.spark = spark
        self.contract = table
        self.name = table.name
        self.path = f"{root.rstrip('/')}/{table.name.replace('.', '/')}"
        self._storage = Storage(spark)

    # Versions ---------------------------------------------------------------------------

    def _numbers(self) -> list[int]:
        names = self._storage.names(f"{self.path}/_versions")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _document(self, number: int) -> str:
        return f"{self.path}/_versions/{number:010d}.json"

    def version(self) -> int | None:
        """The current version number, None if the table does not exist."""
        numbers = self._numbers()
        return numbers[-1] if numbers else None

    def _at(self, number: int | None = None) -> Version:
        number = self.version() if number is None else number
        if number is None:
            raise MissingTable(f"table '{self.name}' does not exist; create it first: Tables.create()")
        return Version.from_json(self._storage.read(self._document(number)))

    def history(self) -> DataFrame:
        """One row per version, newest first."""
        self._at()
        documents = self.spark.read.schema(_VERSION_SCHEMA).json(f"{self.path}/_versions")
        return documents.orderBy(F.col("version").desc())

    def _commit(self, version: Version) -> Version:
        location = self._document(version.number)
        if version.number in self._numbers():
            raise CommitConflict(location)
        try:
            self._storage.create(location, version.to_json())
        except Py4JJavaError as error:
            if "AlreadyExists" in str(error.java_exception):
                raise CommitConflict(location) from error
            raise
        return version

    def create(self) -> SnapshotTable:
        """Create the table, empty, unless it exists."""
        if self.version() is None:
            self._commit(Version(0, "create", self.contract.schema))
        return self

    def restore(self, number: int | None) -> int | None:
        """Make the content of an old version current again; None if there is none."""
        head = self.version()
        if number is None or head is None:
            return None
        old, current = self._at(number), self._at(head)
        self._commit(Version(
            head + 1, f"restore {number}", old.schema, old.slices,
            rows_removed=sum(s.rows for s in set(current.slices) - set(old.slices)),
            rows_written=sum(s.rows for s in set(old.slices) - set(current.slices)),
        ))
        return number

    # Reading ----------------------------------------------------------------------------

    def schema(self) -> T.StructType:
        return self._at().schema

    def slice_values(self) -> set[str | None]:
        return {s.value for s in self._at().slices}

    def read(
        self, *, version: int | None = None, slices: Iterable[str | None] | None = None
    ) -> DataFrame:
        """The table, or only the given slices of it: other directories are not listed."""
        at = self._at(version)
        wanted = None if slices is None else set(slices)
        return self._load(
            at.schema, [s for s in at.slices if wanted is None or s.value in wanted]
        )

    def _load(self, schema: T.StructType, slices: Sequence[Slice]) -> DataFrame:
        if not slices:
            return self.spark.createDataFrame([], schema)
        folders = [f"{self.path}/{s.directory}" for s in slices]
        return self.spark.read.schema(schema).parquet(*folders)

    def read_set_aside(self, run: Run, extra: str) -> DataFrame:
        """The rows a run has set aside, with the columns of ``extra`` (DDL)."""
        schema = T.StructType(run.schema.fields + T.StructType.fromDDL(extra).fields)
        return self._load(schema, run.set_aside)

    # Writing ----------------------------------------------------------------------------

    def write_run(
        self,
        df: DataFrame,
        *,
        evolve: Sequence[str] = (),
        set_aside: Column | None = None,
        extra: str | None = None,
        clustered: bool = False,
    ) -> Run:
        """Write files without publishing them.

        Columns named in ``evolve`` that the table lacks become part of its schema. Rows
        for which ``set_aside`` holds go to directories of their own in the same pass,
        with the additional columns of ``extra``.

        Rows are gathered by slice before the write: small slices share a task, and a
        slice with a third of all rows is split over many. ``clustered`` says that a task
        holds few slices already, as when a file belongs to one batch; the shuffle is saved.
        """
        current = self._at().schema
        added = [f for f in missing_fields(df.schema, current.names) if f.name in set(evolve)]
        schema = T.StructType(current.fields + added)
        written = T.StructType(
            schema.fields + (T.StructType.fromDDL(extra).fields if extra else [])
        )
        target = self.contract
        aside = F.lit(False) if set_aside is None else set_aside
        rows = df.withColumn("_aside", aside.cast("int"))
        kept_aside = T.StructType(written.fields + [T.StructField("_aside", T.IntegerType())])
        if target.surrogate:
            rows = rows.withColumn(target.surrogate, surrogate_key(target.key))
        rows = conform(rows, kept_aside).withColumnRenamed("_aside", _LANE)
        rows = rows.withColumn(_SLICE, F.expr(target.slice_by))

        directory = f"data/run={uuid.uuid4().hex}"
        out = f"{self.path}/{directory}"
        if not clustered:
            rows = rows.hint("rebalance", _LANE, _SLICE)
        rows.write.partitionBy(_LANE, _SLICE).parquet(out)
        release_shuffles(self.spark)
        return self._describe(schema, directory)

    def _describe(self, schema: T.StructType, directory: str) -> Run:
        """Slices and row counts of written files, from their names and footers.

        Counting what was written is right even when a lost executor made tasks run twice.
        """
        out = f"{self.path}/{directory}"
        lanes: dict[str, list[Slice]] = {"0": [], "1": []}
        layout = T.StructType.fromDDL(f"{_LANE} STRING, {_SLICE} STRING")
        counts = {
            (row[_LANE], row[_SLICE]): row["count"]
            for row in self.spark.read.schema(T.StructType(schema.fields + layout.fields))
            .parquet(out).groupBy(_LANE, _SLICE).count().collect()
        }
        for lane in lanes:
            for name in self._storage.names(f"{out}/{_LANE}={lane}"):
                if not name.startswith(f"{_SLICE}="):
                    continue
                text = name.removeprefix(f"{_SLICE}=")
                value = None if text == _NULL_DIRECTORY else unquote(text)
                lanes[lane].append(
                    Slice(value, f"{directory}/{_LANE}={lane}/{name}", counts.get((lane, value), 0))
                )
        values = frozenset(s.value for lane in lanes.values() for s in lane)
        return Run(schema, tuple(lanes["0"]), tuple(lanes["1"]), values)

    def publish_run(
        self, run: Run, mode: str, *, replacing: Iterable[str | None] = ()
    ) -> Version:
        """Make written files part of the table.

        ``append`` adds them, ``replace`` drops the old files of the slices the run has rows
        for (and of those in ``replacing``), ``overwrite`` drops everything else.
        """
        head = self._at()
        if mode == "append":
            gone = []
        elif mode == "replace":
            values = run.values | set(replacing)
            gone = [s for s in head.slices if s.value in values]
        elif mode == "overwrite":
            gone = list(head.slices)
        else:
            raise ValueError(f"unknown publish mode '{mode}'")
        kept = [s for s in head.slices if s not in gone]
        return self._commit(Version(
            head.number + 1, mode, run.schema, (*kept, *run.slices),
            rows_written=sum(s.rows for s in run.slices),
            rows_removed=sum(s.rows for s in gone),
        ))

    def publish(
        self,
        df: DataFrame,
        mode: str = "replace",
        *,
        replacing: Iterable[str | None] = (),
        evolve: Sequence[str] = (),
    ) -> Version:
        return self.publish_run(self.write_run(df, evolve=evolve), mode, replacing=replacing)

    def append_rows(self, rows: Sequence[tuple]) -> Version:
        """Append a few rows made on the driver, such as log entries, as one file."""
        head = self._at()
        frame = self.spark.createDataFrame(list(rows), head.schema).coalesce(1)
        directory = f"data/run={uuid.uuid4().hex}"
        frame.write.parquet(f"{self.path}/{directory}")
        return self._commit(Version(
            head.number + 1, "append", head.schema,
            (*head.slices, Slice(None, directory, len(rows))), rows_written=len(rows),
        ))

    def delete_slices(self, values: Iterable[str | None]) -> int:
        """Drop slices (of a table sliced by batch: batches); returns the rows they held."""
        doomed = set(values)
        head = self._at()
        gone = [s for s in head.slices if s.value in doomed]
        if gone:
            self._commit(Version(
                head.number + 1, "delete", head.schema,
                tuple(s for s in head.slices if s not in gone),
                rows_removed=sum(s.rows for s in gone),
            ))
        return sum(s.rows for s in gone)

    def compact(self) -> Version:
        """Rewrite the slices that consist of several directories into one each."""
        head = self._at()
        values = [s.value for s in head.slices]
        crowded = {v for v, n in Counter(values).items() if n > 1}
        if not crowded:
            return head
        return self.publish(self.read(slices=crowded), "replace", replacing=crowded)

    def upsert(self, df: DataFrame, *, latest: Sequence[str] | None = None) -> Version:
        """Replace rows with the same business key (NULLs match), add the others.

        Only slices that hold a matched key are rewritten. Where the slice follows from
        the key these are the slices of the source; elsewhere a semi-join finds them.
        Of several source rows with one key the one with the highest ``latest`` stays, then
        the one with the highest other values.
        """
        key = self.contract.key
        if not key:
            raise ValueError(f"table '{self.name}' has no business key")
        others = [c for c, kind in df.dtypes if c not in key and "map<" not in kind]
        df = latest_per_key(df, key, [*(latest or ()), *others])
        with scratch(self.spark) as stage:
            skip = [self.contract.surrogate or ""]
            return self._merge(stage(conform(df, self.schema(), skip=skip), "upsert"))

    def _merge(self, source: DataFrame) -> Version:
        key = self.contract.key
        slice_of = F.expr(self.contract.slice_by).alias("slice")
        keys = source.select(*[F.col(c).alias(f"_new_{c}") for c in key])
        same = [F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in key]
        if self.contract.slice_follows_key:
            touched_rows = source.select(slice_of)
        else:
            touched_rows = self.read().join(keys, same, "left_semi").select(slice_of)
        touched = {row["slice"] for row in touched_rows.distinct().collect()}
        kept = self.read(slices=touched).join(keys, same, "left_anti")
        run = self.write_run(kept.unionByName(source, allowMissingColumns=True))
        # A slice without a matched key may still receive new rows: its old files stay.
        head = self._at()
        gone = [s for s in head.slices if s.value in touched]
        return self._commit(Version(
            head.number + 1, "upsert", run.schema,
            (*[s for s in head.slices if s.value not in touched], *run.slices),
            rows_written=sum(s.rows for s in run.slices), rows_removed=sum(s.rows for s in gone),
        ))


class Tables:
    """All tables below one root directory: those of the contracts, and further ones."""

    def __init__(self, spark: SparkSession, root: str, further: Iterable[Contract] = ()):
        self.spark = spark
        self.root = root
        self._further = {table.name: table for table in further}

    def table(self, name: str) -> SnapshotTable:
        return SnapshotTable(self.spark, self.root, self._contract(name))

    def log(self, name: str) -> LogTable:
        return LogTable(self.spark, self.root, self._contract(name))

    def _contract(self, name: str) -> Contract:
        return self._further.get(name) or contract(name)

    def create(self, names: Iterable[str] | None = None) -> Tables:
        for name in (*CONTRACTS, *self._further) if names is None else names:
            (self.log if self._contract(name).log else self.table)(name).create()
        return self

    def read(self, name: str, **options) -> DataFrame:
        return (self.log if self._contract(name).log else self.table)(name).read(**options)


def distinct_batches(df: DataFrame) -> tuple[str, ...]:
    """The batch ids of a frame, without NULL; a result of metadata size."""
    if "batch_id" not in df.columns:
        return ()
    rows = df.select("batch_id").filter("batch_id IS NOT NULL").distinct().collect()
    return tuple(sorted(str(row["batch_id"]) for row in rows))
