"""Catalogue queries for sources, sinks, loads and the job runner.

Each writes test-table rows through a sink into a fresh folder under the
shared checkpoint folder (``spark.checkpoint.dir``) and reads them back
through the matching source, so the result is the round trip of the whole
table.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conformkit.operators.conform import align_to_target, union_conformed
from conformkit.operators.joins import left_join
from conformkit.plans.catalog import query, table
from conformkit.plans.jobs import JobSpec, probe_target_schema, run_services, service
from conformkit.plans.load import full_load_files, incremental_replace_files, load
from conformkit.session import persisted, scratch_path, scratch_table, write_small_text
from conformkit.sinks import files as SNK
from conformkit.sources import files as SRC
from conformkit.specs import LoadSpec, LoadType, SourceSpec

ORDERS_DDL = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING")
EVENTS_DDL = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING")

# The business date the load queries replace.
RUN_DATE = dt.date(2024, 1, 15)


def _part_csv(spark: SparkSession, sf_dir: str, header: bool = True) -> str:
    path = scratch_path(spark, "part-csv")
    SNK.write_csv(table(spark, sf_dir, "part"), path, header=header)
    return path


@query("csv_strings", "SRC-1 SNK-1", """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type,
       CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice
FROM part
""")
def csv_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SRC.read_csv_strings(spark, _part_csv(spark, sf_dir))


@query("csv_typed", "SRC-3 PRJ-8 PRJ-9 SNK-1", "SELECT * FROM part")
def csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The schema comes from config-style (name, type) pairs.
    schema = [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"),
              ("p_type", "string"), ("p_size", "int"), ("p_retailprice", "double")]
    return SRC.read_csv_typed(spark, _part_csv(spark, sf_dir), schema)


@query("csv_ddl_noheader", "SRC-2", "SELECT * FROM orders")
def csv_ddl_noheader(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders-csv")
    SNK.write_csv(table(spark, sf_dir, "orders"), path, header=False)
    return SRC.read_csv_ddl(spark, path, ORDERS_DDL, header=False)


@query("csv_inferred", "SRC-4", """
SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice
FROM part
""")
def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SRC.read_csv_inferred(spark, _part_csv(spark, sf_dir))


@query("text_lines", "SRC-15 SNK-8", "SELECT p_name AS value FROM part")
def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "part-names")
    SNK.write_text(table(spark, sf_dir, "part"), path, "p_name")
    return SRC.read_text_lines(spark, path)


@query("text_documents", "SRC-11", "SELECT p_name AS value FROM part")
def text_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "part-name-docs")
    SNK.write_text(table(spark, sf_dir, "part"), path, "p_name")
    # One row per file with its whole text, then its lines in file order.
    docs = SRC.read_text_documents(spark, path)
    return docs.select(F.explode(SRC.document_lines("value")).alias("value"))


@query("service_source_sql", "PRJ-6 PRJ-7 PRJ-14", """
SELECT CAST(l_shipdate AS DATE) AS mis_date, l_partkey AS instrument, l_quantity AS qty,
       l_extendedprice / l_quantity AS avg_cost, l_extendedprice AS invested
FROM lineitem
""")
def service_source_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The source relation a service names (PRJ-7: the whole table, `select *`),
    # and the service's projection written as SQL text (PRJ-6).  Only the
    # columns the SQL uses are read from the files.
    # The view has a name of its own and is dropped once the frame stands: a frame
    # holds the plan behind the view, not its name.
    view = scratch_table(spark, "lineitem")
    table(spark, sf_dir, "lineitem").createOrReplaceTempView(view)
    try:
        src = SRC.read_source(spark, SourceSpec("lineitem", view, "table"))
    finally:
        spark.catalog.dropTempView(view)
    return spark.sql("""
        SELECT CAST(l_shipdate AS DATE) AS mis_date, l_partkey AS instrument, l_quantity AS qty,
               l_extendedprice / l_quantity AS avg_cost, l_extendedprice AS invested
        FROM {src}""", src=src)


@query("json_multiline", "SRC-12", "SELECT * FROM supplier")
def json_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = table(spark, sf_dir, "supplier")
    path = scratch_path(spark, "supplier-json")
    SNK.write_json_documents(sup, path)
    return SRC.read_json_documents(spark, path, sup.schema, mode="FAILFAST")


@query("optional_source", "SRC-14", "SELECT * FROM part")
def optional_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    absent = SourceSpec(name="late_feed", path=scratch_path(spark, "never-written"),
                        format="parquet", schema=part.schema, optional=True)
    there = SourceSpec("part", f"{sf_dir.rstrip('/')}/part.parquet", "parquet", schema=part.schema, optional=True)
    return union_conformed([SRC.read_source(spark, absent), SRC.read_source(spark, there)])


@query("literal_rows", "SRC-5", """
SELECT o.o_orderstatus, s.status_name, count(*) AS n_orders
FROM orders o LEFT JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'pending'))
     AS s(status, status_name) ON o.o_orderstatus = s.status
GROUP BY o.o_orderstatus, s.status_name
""")
def literal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A three-row lookup typed in by hand.  It is constant-size,
    # so joining it never grows with the data.
    names = SRC.rows(spark, [("F", "finished"), ("O", "open"), ("P", "pending")],
                     "status STRING, status_name STRING")
    counts = table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_orders"))
    return (left_join(counts, F.broadcast(names), F.col("o_orderstatus") == F.col("status"))
            .select("o_orderstatus", "status_name", "n_orders"))


@query("empty_typed", "SRC-6", "SELECT * FROM events")
def empty_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return union_conformed([SRC.empty(spark, events.schema), events])


@query("partitioned_append", "SNK-2", "SELECT * FROM events")
def partitioned_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    path = scratch_path(spark, "events-by-type")
    day = F.col("ts").cast("date")
    SNK.append_partitioned(ev.filter(day < F.lit(RUN_DATE)), path, ["event_type"])
    SNK.append_partitioned(ev.filter((day >= F.lit(RUN_DATE)) | day.isNull()), path, ["event_type"])
    return SRC.read_parquet(spark, path, EVENTS_DDL).select(*ev.columns)


@query("full_then_incremental", "LOD-1 LOD-2 LOD-3", f"""
SELECT *, CAST(ts AS DATE) AS load_date FROM events
WHERE CAST(ts AS DATE) IS DISTINCT FROM DATE '{RUN_DATE}'
UNION ALL
SELECT * REPLACE (value * 2 AS value), CAST(ts AS DATE) FROM events WHERE CAST(ts AS DATE) = DATE '{RUN_DATE}'
""")
def full_then_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full load of every event, then one day replaced, through one LoadSpec."""
    ev = table(spark, sf_dir, "events").withColumn("load_date", F.col("ts").cast("date"))
    full = LoadSpec(scratch_path(spark, "full-then-incremental"), incremental_column="load_date")
    load(spark, ev, full, None)
    day = ev.filter(F.col("load_date") == F.lit(RUN_DATE)).withColumn("value", F.col("value") * 2)
    load(spark, day, replace(full, load_type=LoadType.INCREMENTAL), RUN_DATE)
    return SRC.read_parquet(spark, full.target, f"{EVENTS_DDL}, load_date date").select(*ev.columns)


@query("left_join", "JON-1", """
SELECT d.doc_id, d.lang, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def left_join_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return left_join(docs, labels, ["doc_id"])


# --------------------------------------------------------------------- loads


@query("full_load", "LOD-1 LOD-3", "SELECT * FROM supplier")
def full_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "supplier-copy")
    sup = table(spark, sf_dir, "supplier")
    full_load_files(sup, target)
    full_load_files(sup, target)  # a rerun replaces, never duplicates
    return SRC.read_parquet(spark, target, sup.schema)


_EVENTS_REPLACED_SQL = """
SELECT event_id, ts, user_id, event_type, value, props, CAST(ts AS DATE) AS load_date
FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-15'
UNION ALL
SELECT event_id, ts, user_id, event_type, value * 2, props, CAST(ts AS DATE)
FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'
"""


@query("incremental_replace_files", "LOD-2 FLT-2 FLT-3 DAT-2", _EVENTS_REPLACED_SQL)
def incremental_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    target = scratch_path(spark, "events-daily")
    # Initial load: every day, partitioned by load date.
    full_load_files(ev.withColumn("load_date", F.col("ts").cast("date")), target,
                    partition_by=("load_date",))
    # Rerun of one business day with corrected values; twice, to show the
    # replace is idempotent.
    corrected = (ev.filter(F.col("ts").cast("date") == F.lit(RUN_DATE))
                   .withColumn("value", F.col("value") * 2))
    for _ in range(2):
        incremental_replace_files(spark, corrected, target, "load_date", RUN_DATE)
    return SRC.read_parquet(spark, target, EVENTS_DDL + ", load_date DATE")


@service("catalogue_supplier_copy")
def _supplier_copy(sf: str, loads: dict) -> JobSpec:
    return JobSpec("supplier_copy", SourceSpec("supplier", f"{sf}/supplier.parquet", "parquet"),
                   LoadSpec.from_dict(loads["supplier_copy"]))


@service("catalogue_events_daily")
def _events_daily(sf: str, loads: dict) -> JobSpec:
    return JobSpec("events_daily", SourceSpec("events", f"{sf}/events.parquet", "parquet"),
                   LoadSpec.from_dict(loads["events_daily"]))


@query("run_services", "LOD-4 LOD-5 LOD-6 FLT-3 SRC-13 SNK-7", """
SELECT 'supplier_copy' AS target, CAST(s_suppkey AS BIGINT) AS key, trim(s_name) AS label,
       CAST(s_acctbal AS DOUBLE) AS value FROM supplier
UNION ALL
SELECT 'events_daily', CAST(event_id AS BIGINT), event_type, CAST(value AS DOUBLE)
FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'
""")
def run_services_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "services")
    # The services to run and their loads travel as a JSON file in shared storage (SRC-13).
    config = {
        "services": ["catalogue_supplier_copy", "catalogue_events_daily"],
        "loads": {
            "supplier_copy": {"targetTable": f"{base}/supplier_copy", "load_type": "full",
                              "transformations": [{"column_name": "s_name",
                                                   "expression": "trim(s_name)"}]},
            "events_daily": {"targetTable": f"{base}/events_daily", "load_type": "incremental",
                             "incremental_column": "load_date", "slice_mode": "slice",
                             "transformations": [{"column_name": "load_date",
                                                  "expression": "cast(ts as date)"}]},
        }}
    cfg_path = f"{base}/jobs.json"
    write_small_text(spark, cfg_path, json.dumps(config, indent=2))
    loads = SRC.read_config(spark, cfg_path)["loads"]
    run_services(spark, cfg_path, RUN_DATE, sf=sf_dir.rstrip("/"), loads=loads)
    suppliers = SRC.read_parquet(spark, loads["supplier_copy"]["targetTable"]).select(
        F.lit("supplier_copy").alias("target"), F.col("s_suppkey").cast("long").alias("key"),
        F.col("s_name").alias("label"), F.col("s_acctbal").cast("double").alias("value"))
    events = SRC.read_parquet(spark, loads["events_daily"]["targetTable"]).select(
        F.lit("events_daily"), F.col("event_id").cast("long"), "event_type", F.col("value").cast("double"))
    return suppliers.union(events)


@query("persisted_actions", "PRJ-16", """
SELECT o_orderstatus, count(*) AS n_rows, (SELECT count(*) FROM orders) AS total
FROM orders GROUP BY o_orderstatus
""")
def persisted_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One frame, two actions: its count, then a written summary.
    path = scratch_path(spark, "persisted")
    with persisted(table(spark, sf_dir, "orders").select("o_orderstatus")) as rows:
        total = rows.count()
        (rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"))
         .withColumn("total", F.lit(total).cast("long")).write.parquet(path))
    return spark.read.parquet(path)


@query("probe_target", "SRC-10 FLT-1 PRJ-4", """
SELECT o_orderkey AS key, CAST(o_totalprice AS DECIMAL(18,2)) AS total, o_orderstatus AS status,
       CAST(NULL AS VARCHAR) AS clerk
FROM orders
""")
def probe_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The target's own schema decides: the files of an earlier load (of other rows) give
    # names and types, none of its rows are read.
    target = scratch_path(spark, "probed")
    (table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_acctbal").cast("decimal(18,2)").alias("total"),
        F.lit("O").alias("status"), F.col("c_name").alias("clerk")).write.parquet(target))
    job = JobSpec("probe", SourceSpec("orders", f"{sf_dir.rstrip('/')}/orders.parquet", "parquet"),
                  LoadSpec(target))
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("STATUS"), F.col("o_orderkey").alias("Key"),
        F.col("o_totalprice").alias("total"), "o_orderdate")
    return align_to_target(rows, probe_target_schema(spark, job))
