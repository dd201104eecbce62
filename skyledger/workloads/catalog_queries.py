"""Registered queries on tables of Spark's catalog, dense keys and data set versions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from skyledger.functions.fingerprint import fingerprints, merged
from skyledger.operators.prefix import assign_keys
from skyledger.session import scratch_path, stage_table
from skyledger.sources.catalog import CatalogTable
from skyledger.sources.datasets import DatasetSpec
from skyledger.streaming.rows import stream_rows as start_stream
from skyledger.workloads.adapters import load
from skyledger.workloads.registry import query, wall_clock
from skyledger.workloads.storage_queries import EVENTS, EVENTS_REJECTED, FACTS, dirty_events


def database(spark) -> str:
    """A database of its own below the shared folder."""
    name = f"work_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    return name


def _orders(spark, sf_dir):
    return load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.concat(F.lit("b"), F.year("o_orderdate").cast("string")).alias("batch_id"))


@query
def catalog_replace(spark, sf_dir):
    """Two batches of a named table are replaced, twice with the same rows, and one is deleted."""
    orders = _orders(spark, sf_dir)
    table = CatalogTable(spark, f"{database(spark)}.orders", "batch_id").create(orders.schema)
    table.append(orders)
    again = orders.where("batch_id in ('b1995', 'b1996')").withColumn("o_totalprice", F.lit(0.0))
    table.replace_slices(again)
    table.replace_slices(again)
    table.drop_slices(["b1997"])
    return spark.table(table.name)


@query
def catalog_overwrite(spark, sf_dir):
    """A second run of a whole-table publish leaves one copy, also of slices that are gone by then."""
    orders = _orders(spark, sf_dir)
    table = CatalogTable(spark, f"{database(spark)}.orders", "batch_id").create(orders.schema)
    table.overwrite(orders)
    table.overwrite(orders.where("o_orderstatus <> 'P'"))
    return spark.sql(f"SELECT batch_id, count(*) AS orders, sum(o_custkey) AS customers FROM {table.name} GROUP BY batch_id")


@query
def column_list_insert(spark, sf_dir):
    """Columns that a list leaves out are NULL."""
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    table = CatalogTable(spark, f"{database(spark)}.customers", "c_mktsegment").create(customer.schema)
    table.insert_columns(customer.where("c_acctbal < 0").select("c_mktsegment", "c_name", "c_custkey"))
    table.insert_columns(customer.where("c_acctbal >= 0"))
    return spark.table(table.name)


@query
def dense_keys(spark, sf_dir):
    """Customers come in two batches that overlap; keys stay, new ones go on without a gap."""
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    first = customer.where("c_mktsegment in ('BUILDING', 'MACHINERY')")
    known = stage_table(assign_keys(first.limit(0).withColumn("customer_key", F.lit(0).cast("bigint")), first, ["c_custkey"], "customer_key"), "keys")
    return assign_keys(known, customer, ["c_custkey"], "customer_key")


@query
def dataset_fingerprint(spark, sf_dir):
    """Orders by batch and, merged from these, as a whole."""
    facts = _orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderstatus", "batch_id")
    slices = stage_table(fingerprints(facts, "batch_id"), "fingerprints")
    return slices.unionByName(merged(slices).withColumn("batch_id", F.lit(None).cast("string")))


@query
def stream_rows(spark, sf_dir):
    """Events land as files and stream into named tables; a second start finds nothing new."""
    work, landing = database(spark), scratch_path(spark, "landing")
    lines = dirty_events(spark, sf_dir).withColumn("source_file_name", F.lit("events.csv"))
    lines.write.option("header", True).csv(landing)
    spec = DatasetSpec("events", landing, "csv", f"{work}.events", "app", rejected_table=f"{work}.events_rejected")
    CatalogTable(spark, spec.target_table, "batch_id").create(EVENTS.schema)
    CatalogTable(spark, spec.rejected_table, "batch_id").create(EVENTS_REJECTED.schema)
    checkpoint = scratch_path(spark, "stream")
    for _ in range(2):
        start_stream(spark, spec, lines.columns, stream="events", checkpoint=checkpoint).awaitTermination()
    rejected = spark.table(spec.rejected_table).groupBy("batch_id").agg(F.count("*").alias("rejected"))
    rows = spark.table(spec.target_table).select(*FACTS, "source_file_name", "source_system", "batch_id")
    return wall_clock(rows.join(rejected, "batch_id", "left"))
