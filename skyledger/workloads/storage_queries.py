"""Registered queries that ingest files and publish versioned tables.

Each writes the whole of a test table below the shared folder, in a directory of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.contracts import Contract
from skyledger.functions.casting import conform
from skyledger.operators.lineage import enrich
from skyledger.operators.rescue import (
    rejected_records as as_rejected, split_rescued, type_and_rescue,
)
from skyledger.plans.bronze import ingest
from skyledger.plans.stage import AUDIT_TABLE, RunLog, guarded
from skyledger.session import scratch_path
from skyledger.sources.datasets import RESCUED_COLUMN, DatasetSpec
from skyledger.sources.snapshots import Tables
from skyledger.streaming.ingest import ingest_stream
from skyledger.workloads.adapters import load
from skyledger.workloads.registry import query, wall_clock

EVENTS = Contract(
    "bronze.events_raw",
    """event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE,
    source_file_name STRING, source_system STRING, ingestion_timestamp TIMESTAMP, batch_id STRING""",
    slice_by="batch_id", slice_follows_key=False,
)
EVENTS_REJECTED = Contract(
    "bronze.events_rejected",
    """source_table STRING, source_system STRING, source_file_name STRING,
    rescued_data STRING, raw_payload STRING, batch_id STRING, rejection_timestamp TIMESTAMP""",
    slice_by="batch_id", slice_follows_key=False,
)
ORDERS = Contract(
    "work.orders",
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, batch_id STRING",
    ("o_orderkey",), slice_by="batch_id", slice_follows_key=False,
)
CUSTOMERS = Contract(
    "work.customers",
    "customer_key BIGINT, c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE, c_mktsegment STRING",
    ("c_custkey",), "customer_key", "c_mktsegment", slice_follows_key=False,
)

# The events as dirty text: some values do not fit their type.
_DIRTY = {
    "event_id": "cast(event_id as string)",
    "ts": "date_format(ts, 'yyyy-MM-dd HH:mm:ss')",
    "user_id": "case when event_id % 23 = 3 then concat('u', user_id) else cast(user_id as string) end",
    "event_type": "event_type",
    "value": "case when event_type = 'error' and event_id % 17 < 4 then 'n/a'"
             " else cast(cast(round(value * 100) as bigint) as string) end",
}
FACTS = ("event_id", "ts", "user_id", "event_type", "value")


def dirty_events(spark, sf_dir) -> DataFrame:
    return load(spark, sf_dir, "events").selectExpr(
        *[f"{text} AS {name}" for name, text in _DIRTY.items()]
    )


def _judged_events(spark, sf_dir) -> DataFrame:
    source = dirty_events(spark, sf_dir).selectExpr(
        "*", "CAST(NULL AS MAP<STRING, STRING>) AS _unknown", "CAST(NULL AS STRING) AS _malformed",
        "concat('events_', event_type, '.csv') AS _file",
    )
    schema = EVENTS.schema.__class__(EVENTS.schema.fields[:5])
    judged = type_and_rescue(source, schema)
    return enrich(judged, file_name=F.col("_file"), source_system="app", batch_id="b1")


def _tables(spark, *contracts: Contract) -> Tables:
    tables = Tables(spark, scratch_path(spark, "tables"), contracts)
    return tables.create([AUDIT_TABLE, *[table.name for table in contracts]])


@query
def rescued_split(spark, sf_dir):
    clean, rescued = split_rescued(_judged_events(spark, sf_dir))
    lanes = clean.withColumn(RESCUED_COLUMN, F.lit(None).cast("string")).withColumn("lane", F.lit("clean"))
    return wall_clock(
        lanes.unionByName(rescued.withColumn("lane", F.lit("rescued")))
        .select(*FACTS, "lane", F.col(RESCUED_COLUMN).alias("rescued_data"))
    )


@query
def rejected_records(spark, sf_dir):
    _, rescued = split_rescued(_judged_events(spark, sf_dir))
    rejected = as_rejected(rescued, source_table=EVENTS.name, source_system="app")
    return rejected.drop("rejection_timestamp")


@query
def align_schema(spark, sf_dir):
    schema = Contract(
        "lines", "l_orderkey STRING, l_linenumber BIGINT, l_quantity INT, l_note STRING, l_shipdate DATE"
    ).schema
    return conform(load(spark, sf_dir, "lineitem"), schema)


@query
def enrich_metadata(spark, sf_dir):
    events = load(spark, sf_dir, "events").selectExpr(
        "event_id", "case when event_type = 'view' then ' ' else event_type end AS source_file_name",
        "CAST(ts AS TIMESTAMP) AS ingestion_timestamp",
        "case when event_type = 'click' then null else concat('b_', event_type) end AS batch_id",
    )
    return wall_clock(enrich(
        events, file_name=F.lit("landed.csv"), source_system="app", default_batch="run-1"
    ))


def _orders(spark, sf_dir) -> DataFrame:
    return load(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        "concat('b', cast(year(o_orderdate) as string)) AS batch_id",
    )


_FIRST_BATCH = "batch_id = 'b1995'"


@query
def replace_batch(spark, sf_dir):
    """A rerun of one batch replaces its rows and leaves the other batches alone."""
    orders, table = _orders(spark, sf_dir), _tables(spark, ORDERS).table(ORDERS.name)
    table.publish(orders)
    table.publish(orders.filter(_FIRST_BATCH).withColumn("o_totalprice", F.lit(0.0)))
    return table.read()


@query
def delete_batch(spark, sf_dir):
    table = _tables(spark, ORDERS).table(ORDERS.name)
    table.publish(_orders(spark, sf_dir))
    table.delete_slices(["b1995", "b1996", "it's none"])
    return table.read()


@query
def append_batches(spark, sf_dir):
    orders, table = _orders(spark, sf_dir), _tables(spark, ORDERS).table(ORDERS.name)
    table.publish(orders.filter("o_orderstatus = 'F'"), "append")
    table.publish(orders.filter("o_orderstatus <> 'F'"), "append")
    return table.read()


@query
def append_and_compact(spark, sf_dir):
    orders, table = _orders(spark, sf_dir), _tables(spark, ORDERS).table(ORDERS.name)
    table.publish(orders.filter("o_orderstatus = 'F'"), "append")
    table.publish(orders.filter("o_orderstatus <> 'F'"), "append")
    table.compact()
    return table.read()


@query
def evolve_schema(spark, sf_dir):
    """The second batch brings a column the table does not have yet."""
    orders, table = _orders(spark, sf_dir), _tables(spark, ORDERS).table(ORDERS.name)
    table.publish(orders.filter(_FIRST_BATCH))
    later = orders.filter(f"NOT {_FIRST_BATCH}").withColumn(
        "priority", F.upper("o_orderstatus")
    )
    table.publish(later, evolve=["priority"])
    return table.read()


@query
def upsert(spark, sf_dir):
    """Customers of one segment move to another one, and every customer gets a twin, which comes
    with an outdated version, and a row without a key. The second run finds all of it there."""
    customers, table = load(spark, sf_dir, "customer"), _tables(spark, CUSTOMERS).table(CUSTOMERS.name)
    table.publish(customers, "overwrite")
    moved = customers.filter("c_mktsegment = 'BUILDING'").withColumn("c_mktsegment", F.lit("MACHINERY"))
    twins = customers.withColumn("c_custkey", -1 - F.col("c_custkey"))
    outdated = twins.withColumn("c_acctbal", F.col("c_acctbal") - 1)
    nameless = customers.withColumn("c_custkey", F.lit(None).cast("bigint"))
    for _ in range(2):
        table.upsert(moved.unionByName(twins).unionByName(outdated).unionByName(nameless), latest=["c_acctbal"])
    return table.read().drop("customer_key")


@query
def surrogate_keys(spark, sf_dir):
    """Hash keys must not collide and must not depend on the run."""
    customers = load(spark, sf_dir, "customer")
    first, second = (_tables(spark, CUSTOMERS).table(CUSTOMERS.name) for _ in range(2))
    first.publish(customers, "overwrite")
    second.publish(customers.withColumn("c_acctbal", F.lit(0.0)), "overwrite")
    same = first.read().select("c_custkey", "customer_key").intersect(
        second.read().select("c_custkey", "customer_key")
    )
    return same.groupBy("customer_key").count().agg(
        F.count("*").alias("keys"), F.sum("count").alias("customers"),
        F.max("count").alias("customers_per_key"),
    )


def _poisoned(spark, sf_dir):
    orders, table = _orders(spark, sf_dir), _tables(spark, ORDERS).table(ORDERS.name)
    table.publish(orders, "overwrite")
    table.publish(orders.withColumn("o_totalprice", F.lit(None).cast("double")), "append")
    table.restore(1)
    return table


@query
def restore_version(spark, sf_dir):
    return _poisoned(spark, sf_dir).read()


@query
def table_history(spark, sf_dir):
    return _poisoned(spark, sf_dir).history().drop("committed_at")


@query
def stage_rollback_audit(spark, sf_dir):
    """A stage that fails after publishing: the table keeps its rows, the log tells why."""
    orders, tables = _orders(spark, sf_dir), _tables(spark, ORDERS)
    table, log = tables.table(ORDERS.name), RunLog(tables, "orders")
    with guarded(log, "load", [table], run_id="r1") as done:
        done.record(table.publish(orders, "overwrite"))
    try:
        with guarded(log, "poison", [table], run_id="r2"):
            table.publish(orders.limit(0), "overwrite")
            raise ValueError("upstream file is broken")
    except ValueError:
        pass
    events = tables.read(AUDIT_TABLE)
    kept = table.read().agg(F.count("*").alias("rows_kept"), F.lit("load").alias("stage_name"))
    return events.select(
        "pipeline_name", "stage_name", "target_table", "run_id", "status", "rows_written",
        "rows_removed", "restored_version", "error_message",
    ).join(kept, "stage_name", "left")


def _landed(spark, sf_dir, kind: str) -> DatasetSpec:
    """Write the dirty events as files and describe them as a dataset."""
    path = scratch_path(spark, f"landing-{kind}")
    rows = dirty_events(spark, sf_dir).withColumn("source_file_name", F.concat(F.lit("events."), F.lit(kind)))
    if kind == "csv":
        rows.write.option("header", True).csv(path)
    else:
        rows.write.json(path)
    return DatasetSpec(
        "events", path, "csv" if kind == "csv" else "jsonl", EVENTS.name, "app",
        rejected_table=EVENTS_REJECTED.name,
    )


def _ingested(tables: Tables) -> DataFrame:
    rows = tables.read(EVENTS.name).select(*FACTS, "source_file_name", "source_system", "batch_id")
    rejected = tables.read(EVENTS_REJECTED.name).groupBy("batch_id").agg(F.count("*").alias("rejected"))
    return wall_clock(rows.join(rejected, "batch_id", "left"))


@query
def csv_ingest(spark, sf_dir):
    """Twice over the same files: the second run replaces the first."""
    tables, spec = _tables(spark, EVENTS, EVENTS_REJECTED), _landed(spark, sf_dir, "csv")
    for _ in range(2):
        ingest(tables, spec, batch_id="b1")
    return _ingested(tables)


@query
def jsonl_ingest(spark, sf_dir):
    tables, spec = _tables(spark, EVENTS, EVENTS_REJECTED), _landed(spark, sf_dir, "jsonl")
    ingest(tables, spec, batch_id="b1")
    return _ingested(tables)


@query
def mixed_ingest(spark, sf_dir):
    """Half of the rows lie in CSV files, half in files of JSON lines, below one path."""
    tables, path = _tables(spark, EVENTS, EVENTS_REJECTED), scratch_path(spark, "landing-mixed")
    rows = dirty_events(spark, sf_dir).withColumn("source_file_name", F.lit("events.mixed"))
    half = F.xxhash64(*rows.columns) % 2 == 0
    rows.where(half).write.option("header", True).csv(f"{path}/kind=csv")
    rows.where(~half).write.json(f"{path}/kind=json")
    spec = DatasetSpec("events", path, "mixed", EVENTS.name, "app", rejected_table=EVENTS_REJECTED.name)
    for _ in range(2):
        ingest(tables, spec, batch_id="b1")
    return _ingested(tables)


@query
def stream_ingest(spark, sf_dir):
    """The stream is started twice on the same files; the second start finds nothing new."""
    tables, spec = _tables(spark, EVENTS, EVENTS_REJECTED), _landed(spark, sf_dir, "csv")
    checkpoint = scratch_path(spark, "stream")
    for _ in range(2):
        ingest_stream(tables, spec, stream="events", checkpoint=checkpoint, glob="*.csv").awaitTermination()
    return _ingested(tables)
