"""Catalogue queries for nested alignment, free text in CSV, row positions, drifting
JSON, and jobs that are run again."""

from __future__ import annotations

import json

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conformkit.functions import maps as MP
from conformkit.operators import positions as P
from conformkit.operators.conform import align_to_target
from conformkit.plans import ledger as LG
from conformkit.plans.catalog import query, table
from conformkit.plans.jobs import JobSpec, probe_target_schema, run_jobs
from conformkit.plans.load import kept_rows, load
from conformkit.plans.mapping import load_mapping, run_mapping
from conformkit.plans.queries_core import _PARTY_SUMMARY_SQL, party_mapping
from conformkit.plans.queries_io import EVENTS_DDL, RUN_DATE
from conformkit.plans.rollup import run_rollup
from conformkit.session import scratch_path, scratch_table, write_small_text
from conformkit.sinks import files as SNK
from conformkit.sources import files as SRC
from conformkit.specs import LoadSpec, LoadType, MeasureSpec, SourceSpec, build_schema

# ------------------------------------------------------------------ nested columns

NESTED_TARGET = (
    ("event_id", "bigint"),
    ("event", "struct<origin:string,props:struct<K:bigint,seen:date>,type:string>"),
    ("readings", "array<struct<V:decimal(18,2),flag:boolean,unit:string>>"),
    ("by_type", "map<string,struct<u:string,v:double>>"),
)


@query("align_nested", "PRJ-3 PRJ-4", """
SELECT event_id, CAST(NULL AS VARCHAR) AS origin, event_type AS type, CAST(props->>'$.k' AS BIGINT) AS k,
       CAST(NULL AS DATE) AS seen, CAST(value AS DECIMAL(18,2)) AS v, CAST(NULL AS BOOLEAN) AS flag, 'eur' AS unit,
       CAST(user_id AS VARCHAR) AS u, value AS map_v
FROM events
""")
def align_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    # Fields in another order, case and type than the target's; some more, some less.
    rows = ev.select(
        F.struct(F.col("event_type").alias("TYPE"), F.from_json("props", "struct<k:int>").alias("props"),
                 F.col("ts").alias("at")).alias("EVENT"),
        F.array(F.struct(F.lit("eur").alias("unit"), F.col("value").alias("v"))).alias("readings"),
        F.create_map("event_type", F.struct(F.col("value").alias("v"), F.col("user_id").alias("U"))).alias("by_type"),
        F.col("event_id").cast("string").alias("event_id"))
    out = align_to_target(rows, build_schema(NESTED_TARGET))
    reading, entry = F.get("readings", 0), MP.lookup("by_type", F.col("event.type"))
    return out.select(
        "event_id", "event.origin", "event.type", F.col("event.props.K").alias("k"), "event.props.seen",
        reading["V"].alias("v"), reading["flag"].alias("flag"), reading["unit"].alias("unit"),
        entry["u"].alias("u"), entry["v"].alias("map_v"))


# ------------------------------------------------------------------ free text in CSV


@query("csv_documents", "SRC-3 SNK-1", r"""
SELECT doc_id, text, lang, '  ' || text || chr(10) || ' ' AS padded, '"' || text || '",\' AS quoted,
       '' AS empty, CAST(NULL AS VARCHAR) AS nothing, n_chars
FROM documents
""")
def csv_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Whole texts with line breaks, with blanks and quotes at their ends, empty and null.
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", F.concat(F.lit("  "), "text", F.lit("\n ")).alias("padded"),
        F.concat(F.lit('"'), "text", F.lit('",\\')).alias("quoted"), F.lit("").alias("empty"),
        F.lit(None).cast("string").alias("nothing"), "n_chars")
    path = scratch_path(spark, "documents-csv")
    SNK.write_csv(docs, path, rows_per_file=2_000)
    return SRC.read_csv_typed(spark, path, docs.schema, multiline=True, mode="FAILFAST")


@query("csv_pages", "SRC-1 SNK-1", "SELECT CAST(page_id AS VARCHAR) AS page_id, url, html FROM pages")
def csv_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "pages-csv")
    SNK.write_csv(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path, rows_per_file=2_000)
    return SRC.read_csv_strings(spark, path, multiline=True)


@query("csv_rejects", "SRC-3", """
SELECT count(*) AS n_rows, CAST(count(*) FILTER (WHERE p_size > 25) AS BIGINT) AS n_corrupt FROM part
""")
def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_size") > 25, F.col("p_type")).otherwise(F.col("p_size").cast("string")).alias("p_size"),
        "p_name")
    path = scratch_path(spark, "part-sizes-csv")
    SNK.write_csv(part, path)
    per_file = SRC.csv_reject_counts(spark, path, "p_partkey bigint, p_size int, p_name string")
    return per_file.agg(F.sum("n_rows").alias("n_rows"), F.sum("n_corrupt").alias("n_corrupt"))


@query("text_escaped", "SNK-8 SRC-15", "SELECT text AS value FROM documents")
def text_escaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "document-lines")
    SNK.write_text(table(spark, sf_dir, "documents"), path, "text", newlines="escape")
    return SRC.read_text_lines(spark, path, escaped=True)


# ------------------------------------------------------------------ positions


@query("numbered_rows", "WIN-1", """
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS pos FROM orders
""")
def numbered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return P.number_rows(orders, [F.col("o_totalprice").desc(), "o_orderkey"])


@query("first_position", "WIN-2", """
SELECT min(pos) AS first_pos FROM (
    SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS pos FROM orders)
WHERE o_orderpriority = '1-URGENT'
""")
def first_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    return P.first_position(P.number_rows(orders, ["o_orderdate", "o_orderkey"]), F.col("o_orderpriority") == "1-URGENT")


@query("paired_rows", "JON-3 WIN-1", """
SELECT pos, o_orderkey, o_orderdate, p_partkey, p_name FROM
    (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS pos FROM orders)
    JOIN (SELECT *, row_number() OVER (ORDER BY p_name DESC, p_partkey) - 1 AS pos FROM part) USING (pos)
""")
def paired_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Two tables side by side, each in its own order; the shorter one ends the pairs.
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return P.pair_by_position([(orders, ["o_orderdate", "o_orderkey"]), (part, [F.col("p_name").desc(), "p_partkey"])])


# ------------------------------------------------------------------ drifting JSON

# The same property as a number, a text, a list, an object, or cut off, by event type.
_DRIFT_SQL = """CASE event_type WHEN 'click' THEN props
    WHEN 'view' THEN '{"k": "' || event_type || user_id || '"}' WHEN 'error' THEN '{"k": [' || user_id || ', 7]}'
    WHEN 'signup' THEN '{"k": {"at": ' || user_id || '}}' ELSE left(props, length(props) - 1) END"""


def drifting(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "props")
    return ev.select("event_id", "event_type", F.expr(_DRIFT_SQL).alias("props"))


@query("json_variant", "JSN-1 MAP-4", f"""
SELECT event_id,
       CASE event_type WHEN 'click' THEN 'BIGINT' WHEN 'view' THEN 'STRING' WHEN 'error' THEN 'ARRAY<BIGINT>'
                       WHEN 'signup' THEN 'OBJECT<at: BIGINT>' END AS kind,
       CASE event_type WHEN 'click' THEN CAST(props->>'$.k' AS BIGINT) END AS k_number,
       CASE event_type WHEN 'error' THEN CAST(props->>'$.k[0]' AS BIGINT) END AS first_k,
       CASE event_type WHEN 'signup' THEN CAST(props->>'$.k.at' AS BIGINT) END AS k_at,
       CASE event_type WHEN 'view' THEN props->>'$.k' END AS k_text
FROM (SELECT event_id, event_type,
             CASE WHEN event_type <> 'purchase' THEN {_DRIFT_SQL} END AS props FROM events)
""")
def json_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Parsed once into a column; every path reads the parsed value.
    v = drifting(spark, sf_dir).select("event_id", MP.parse_variant("props").alias("v"))
    kind = MP.variant_kind("v", "$.k")
    return v.select(
        "event_id", kind.alias("kind"),
        F.when(kind == "BIGINT", MP.variant_get("v", "$.k", "bigint")).alias("k_number"),
        MP.variant_get("v", "$.k[0]", "bigint").alias("first_k"),
        MP.variant_get("v", "$.k.at", "bigint").alias("k_at"),
        F.when(kind == "STRING", MP.variant_get("v", "$.k")).alias("k_text"))


@query("json_faults", "JSN-1", """
SELECT event_type, count(*) AS n_rows, CAST(count(*) FILTER (WHERE props IS NULL) AS BIGINT) AS n_absent,
       CAST(count(*) FILTER (WHERE event_type = 'purchase' AND props IS NOT NULL) AS BIGINT) AS n_malformed
FROM events GROUP BY event_type
""")
def json_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MP.json_faults(drifting(spark, sf_dir), "props", "event_type")


@query("map_items", "MAP-1", """
SELECT event_id, 'k' AS key, CAST(props->>'$.k' AS INTEGER) AS value, CAST(props->>'$.k' AS INTEGER) AS total FROM events
""")
def map_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One row per entry, with the sum over the map's values beside it.
    m = table(spark, sf_dir, "events").select("event_id", MP.parse_json_map("props").alias("m"))
    total = F.aggregate(MP.values("m"), F.lit(0), lambda a, x: a + x)
    return (m.select("event_id", total.alias("total"), F.explode(MP.items("m")).alias("e"))
            .select("event_id", "e.key", "e.value", "total"))


# ------------------------------------------------------------------ jobs run again


@query("slice_removed", "FLT-2", f"""
SELECT event_id, CAST(ts AS DATE) AS load_date FROM events WHERE CAST(ts AS DATE) IS DISTINCT FROM DATE '{RUN_DATE}'
""")
def slice_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("date").alias("load_date"))
    return kept_rows(ev, "load_date", RUN_DATE)


@query("rerun_services", "LOD-4 LOD-6", """
SELECT 'customers' AS job, count(*) AS n_rows, CAST(count(*) AS BIGINT) AS n_keys FROM customer
UNION ALL SELECT 'late_suppliers', count(*), CAST(count(*) AS BIGINT) FROM supplier
UNION ALL SELECT 'orders', count(*), CAST(count(*) AS BIGINT) FROM orders
""")
def rerun_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three jobs; the second fails on the first run, so the third has not run.  The
    rerun goes on behind the first: its rows carry the name of the run."""
    base, sf = scratch_path(spark, "rerun"), sf_dir.rstrip("/")

    def job(name: str, source: str, key: str, run: str, broken: bool = False) -> JobSpec:
        fault = F.raise_error(F.lit("the feed broke off")) if broken else F.lit(run)
        return JobSpec(name, lambda s, _: s.read.parquet(f"{sf}/{source}.parquet").select(
            F.col(key).alias("key"), fault.cast("string").alias("run")), LoadSpec(f"{base}/{name}"))

    def jobs(run: str, broken: bool) -> list[JobSpec]:
        # The first job is the same in both runs.
        return [job("customers", "customer", "c_custkey", "first"), job("late_suppliers", "supplier", "s_suppkey", run, broken),
                job("orders", "orders", "o_orderkey", run)]

    try:
        run_jobs(spark, jobs("first", True), RUN_DATE, ledger=f"{base}/ledger")
    except PySparkException as e:
        if "the feed broke off" not in str(e):
            raise
    run_jobs(spark, jobs("second", False), RUN_DATE, ledger=f"{base}/ledger")
    done = LG.entries(spark, f"{base}/ledger").where(F.col("run_date") == F.lit(RUN_DATE)).select("job")
    wanted = {"customers": "first", "late_suppliers": "second", "orders": "second"}
    rows = [SRC.read_parquet(spark, f"{base}/{name}", "key bigint, run string").where(F.col("run") == run)
            .agg(F.lit(name).alias("job"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct("key").alias("n_keys"))
            for name, run in wanted.items()]
    counts = rows[0].union(rows[1]).union(rows[2])
    return done.join(counts, "job")


@query("table_full_then_incremental", "LOD-1 LOD-2 LOD-3 SRC-10", f"""
SELECT event_id, ts, user_id, event_type, value, props, CAST(ts AS DATE) AS load_date
FROM events WHERE CAST(ts AS DATE) IS DISTINCT FROM DATE '{RUN_DATE}'
UNION ALL
SELECT event_id, ts, user_id, event_type, value * 2, NULL, CAST(ts AS DATE) FROM events WHERE CAST(ts AS DATE) = DATE '{RUN_DATE}'
""")
def table_full_then_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A managed table loaded in full, twice, then one day replaced by rows that lack
    a column, aligned to the schema that the table itself gives."""
    name = scratch_table(spark, "events_daily")
    full = LoadSpec(name, incremental_column="load_date", format="table")
    ev = table(spark, sf_dir, "events").withColumn("load_date", F.col("ts").cast("date"))
    load(spark, ev.limit(0), full, None)
    load(spark, ev, full, None)
    step = JobSpec("events_daily", SourceSpec("events", f"{sf_dir.rstrip('/')}/events.parquet", "parquet"),
                   LoadSpec(name, LoadType.INCREMENTAL, "load_date", format="table"))
    day = ev.where(F.col("load_date") == F.lit(RUN_DATE)).select(
        (F.col("value") * 2).alias("VALUE"), "ts", "event_id", "event_type", "user_id", "load_date")
    for _ in range(2):
        load(spark, align_to_target(day, probe_target_schema(spark, step)), step.load, RUN_DATE)
    return SRC.read_source(spark, SourceSpec("events_daily", name, "table"))


@query("batch_append", "SNK-2", f"""
SELECT *, CASE WHEN CAST(ts AS DATE) < DATE '{RUN_DATE}' THEN 'early' ELSE 'late' END AS batch_id FROM events
""")
def batch_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    path = scratch_path(spark, "events-batches")
    early = F.col("ts").cast("date") < F.lit(RUN_DATE)
    # The first run of `late` had more rows, of more types; its rerun replaces it.
    for rows, batch in ((ev, "late"), (ev.where(early), "early"), (ev.where(~F.coalesce(early, F.lit(False))), "late"),
                        (ev.where(early), "early")):
        SNK.append_batch(rows, path, batch, ["event_type"])
    return SRC.read_parquet(spark, path, f"{EVENTS_DDL}, batch_id string").select(*ev.columns, "batch_id")


@query("mapping_job", "LOD-8 SRC-1 SNK-1 SRC-13 AGG-1", _PARTY_SUMMARY_SQL)
def mapping_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole mapping job from files to file: two CSV feeds and a JSON config in,
    the summary out as CSV, read back with its types."""
    base = scratch_path(spark, "mapping-job")
    sources = []
    for s, feed in zip(party_mapping(sf_dir).sources, ("customer", "supplier")):
        SNK.write_csv(table(spark, sf_dir, feed), f"{base}/{feed}")
        sources.append({"source_name": s.name, "path": f"{base}/{feed}", "transformations": [
            {"column_name": t.column_name, "expression": t.expression} for t in s.transformations]})
    spec = party_mapping(sf_dir)
    write_small_text(spark, f"{base}/mapping.json", json.dumps({
        "data_sources": sources, "columns": [{"col_name": c, "col_type": t} for c, t in spec.columns],
        "keys": spec.keys, "output_path": f"{base}/summary",
        "measures": [{"name": m.name, "func": m.func, "column": m.column, "out": m.out} for m in spec.measures]}))
    out = run_mapping(spark, load_mapping(spark, f"{base}/mapping.json"))
    return SRC.read_csv_typed(spark, f"{base}/summary", out.schema)


@query("rollup_job", "AGG-4 SRC-3 PRJ-8 PRJ-9 PRJ-11", """
SELECT CAST(l_partkey AS BIGINT) AS instrument, sum(l_quantity) AS quantity_sum, avg(l_quantity) AS quantity_mean,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS invested
FROM lineitem GROUP BY l_partkey
""")
def rollup_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roll-up job from its config file: lineitem as CSV, typed by the config."""
    base = scratch_path(spark, "rollup-job")
    SNK.write_csv(table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice"), f"{base}/lines")
    write_small_text(spark, f"{base}/holdings.json", json.dumps({"holdings": {
        "sourceCSVPath": f"{base}/lines",
        "readSchema": [{"col_name": "l_partkey", "col_type": "bigint"}, {"col_name": "l_quantity", "col_type": "double"},
                       {"col_name": "l_extendedprice", "col_type": "decimal(18,2)"}],
        "transformations": [{"column_name": "instrument", "expression": "l_partkey"},
                            {"column_name": "paid", "expression": "l_extendedprice"}]}}))
    return run_rollup(spark, f"{base}/holdings.json", ["instrument"], [
        MeasureSpec("quantity_sum", "sum", "l_quantity"), MeasureSpec("quantity_mean", "avg", "l_quantity"),
        MeasureSpec("invested", "sum", "paid", out="double")])
