"""Catalogue queries for the mapping job, alignment and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conformkit.operators import summarize as S
from conformkit.operators.conform import align_to_target, apply_transformations, conform_and_union
from conformkit.operators.joins import left_join
from conformkit.plans import mapping as M
from conformkit.plans.catalog import query, table
from conformkit.specs import MappingSpec, MeasureSpec, build_schema


def party_mapping(sf_dir: str) -> MappingSpec:
    """Two sources with different columns conformed into one 'party' table:
    customer has a market segment, supplier has none (stand-ins for the
    reference's two mark sheets)."""
    sf = sf_dir.rstrip("/")
    return MappingSpec.from_dict({
        "data_sources": [
            {"source_name": "CUST", "format": "parquet", "path": f"{sf}/customer.parquet",
             "transformations": [
                 {"column_name": "party_key", "expression": "c_custkey"},
                 {"column_name": "party_name", "expression": "trim(c_name) as name"},
                 {"column_name": "nation_key", "expression": "c_nationkey"},
                 {"column_name": "acctbal", "expression": "c_acctbal"},
                 {"column_name": "segment", "expression": "c_mktsegment"},
                 {"column_name": "source_key", "expression": "'CUST'"}]},
            {"source_name": "SUPP", "format": "parquet", "path": f"{sf}/supplier.parquet",
             "transformations": [
                 {"column_name": "party_key", "expression": "s_suppkey"},
                 {"column_name": "party_name", "expression": "trim(s_name) as name"},
                 {"column_name": "nation_key", "expression": "s_nationkey"},
                 {"column_name": "acctbal", "expression": "s_acctbal"},
                 {"column_name": "source_key", "expression": "'SUPP'"}]},
        ],
        "columns": [
            {"col_name": "party_key", "col_type": "bigint"},
            {"col_name": "party_name", "col_type": "string"},
            {"col_name": "nation_key", "col_type": "int"},
            {"col_name": "acctbal", "col_type": "decimal(18,2)"},
            {"col_name": "segment", "col_type": "string"},
            {"col_name": "source_key", "col_type": "string"},
        ],
        "keys": ["source_key", "nation_key"],
        "measures": [
            {"name": "n_rows", "func": "count_star"},
            {"name": "total_acctbal", "func": "sum", "column": "acctbal", "out": "double"},
            {"name": "max_acctbal", "func": "max", "column": "acctbal", "out": "double"},
            {"name": "min_acctbal", "func": "min", "column": "acctbal", "out": "double"},
        ],
    })


_PARTY_SQL = """
    SELECT CAST(c_custkey AS BIGINT) AS party_key, trim(c_name) AS party_name,
           CAST(c_nationkey AS INTEGER) AS nation_key,
           CAST(c_acctbal AS DECIMAL(18,2)) AS acctbal,
           c_mktsegment AS segment, 'CUST' AS source_key
    FROM customer
    UNION ALL
    SELECT CAST(s_suppkey AS BIGINT), trim(s_name), CAST(s_nationkey AS INTEGER),
           CAST(s_acctbal AS DECIMAL(18,2)), CAST(NULL AS VARCHAR), 'SUPP'
    FROM supplier
"""

_PARTY_SUMMARY_SQL = f"""
SELECT source_key, nation_key, count(*) AS n_rows,
       CAST(sum(acctbal) AS DOUBLE) AS total_acctbal,
       CAST(max(acctbal) AS DOUBLE) AS max_acctbal,
       CAST(min(acctbal) AS DOUBLE) AS min_acctbal
FROM ({_PARTY_SQL}) conformed
GROUP BY source_key, nation_key
"""


@query("mapping_summary", "LOD-8 PRJ-1 PRJ-3 PRJ-10 SET-1 SET-2 AGG-1", _PARTY_SUMMARY_SQL)
def mapping_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.summary(spark, party_mapping(sf_dir))


@query("mapping_rows", "PRJ-1 PRJ-3 PRJ-15 SET-1 SET-2 STR-1",
       f"SELECT * FROM ({_PARTY_SQL}) conformed")
def mapping_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.conformed(spark, party_mapping(sf_dir))


@query("mapping_summary_sql", "PRJ-14 AGG-2", _PARTY_SUMMARY_SQL)
def mapping_summary_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.conformed(spark, party_mapping(sf_dir))
    # spark.sql with a DataFrame argument binds a view local to this query, so
    # concurrent jobs never clobber each other's temp view names.
    return spark.sql("""
        SELECT source_key, nation_key, count(*) AS n_rows,
               CAST(sum(acctbal) AS DOUBLE) AS total_acctbal,
               CAST(max(acctbal) AS DOUBLE) AS max_acctbal,
               CAST(min(acctbal) AS DOUBLE) AS min_acctbal
        FROM {party}
        GROUP BY source_key, nation_key""", party=rows)


@query("mapping_separate_measures", "AGG-3", f"""
WITH c AS ({_PARTY_SQL})
SELECT source_key, nation_key, 'counts' AS measure_set, 'n_rows' AS measure,
       CAST(count(*) AS DOUBLE) AS value FROM c GROUP BY source_key, nation_key
UNION ALL
SELECT source_key, nation_key, 'totals', 'total_acctbal', CAST(sum(acctbal) AS DOUBLE)
FROM c GROUP BY source_key, nation_key
UNION ALL
SELECT source_key, nation_key, 'totals', 'max_acctbal', CAST(max(acctbal) AS DOUBLE)
FROM c GROUP BY source_key, nation_key
UNION ALL
SELECT source_key, nation_key, 'lows', 'min_acctbal', CAST(min(acctbal) AS DOUBLE)
FROM c GROUP BY source_key, nation_key
""")
def mapping_separate_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.conformed(spark, party_mapping(sf_dir))
    return S.measure_report(rows, ["source_key", "nation_key"], {
        "counts": [MeasureSpec("n_rows", "count_star")],
        "totals": [MeasureSpec("total_acctbal", "sum", "acctbal"),
                   MeasureSpec("max_acctbal", "max", "acctbal")],
        "lows": [MeasureSpec("min_acctbal", "min", "acctbal")],
    })


# A declared target, as a live target table's zero-row probe would report it:
# other spelling of case, a column the source lacks, narrower/wider types.
ORDERS_TARGET = build_schema([
    ("O_ORDERKEY", "bigint"),
    ("o_custkey", "string"),
    ("O_OrderStatus", "string"),
    ("o_totalprice", "decimal(18,2)"),
    ("o_orderdate", "date"),
    ("o_clerk", "string"),
    ("o_orderpriority", "string"),
])


@query("align_to_target", "PRJ-4 PRJ-5 PRJ-15", """
SELECT CAST(o_orderkey AS BIGINT) AS O_ORDERKEY, CAST(o_custkey AS VARCHAR) AS o_custkey,
       o_orderstatus AS O_OrderStatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, CAST(NULL AS VARCHAR) AS o_clerk,
       o_orderpriority AS o_orderpriority
FROM orders
""")
def align_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_to_target(table(spark, sf_dir, "orders"), ORDERS_TARGET)


@query("derived_columns", "PRJ-2 PRJ-3 SET-1 SET-2", """
SELECT CAST(r_regionkey AS VARCHAR) AS id, r_name AS name, CAST(NULL AS BIGINT) AS region,
       CAST(NULL AS DOUBLE) AS balance FROM region
UNION ALL
SELECT CAST(c_custkey AS VARCHAR), NULL, CAST(c_nationkey AS BIGINT), NULL FROM customer
UNION ALL
SELECT s_name, NULL, NULL, CAST(s_acctbal AS DOUBLE) FROM supplier
""")
def derived_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    # No declared columns: names and types come from the three sources, whose id
    # is a number in two and text in one.
    region = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("ID"), F.lit(None).alias("name"), F.col("c_nationkey").cast("long").alias("region"))
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("id"), F.col("s_acctbal").cast("double").alias("balance"))
    return conform_and_union([("region", region), ("customer", customer), ("supplier", supplier)])


# --------------------------------------------------------------- roll-ups (AGG-4..8)

@query("holdings_rollup", "AGG-4 PRJ-11 PRJ-1", """
SELECT CAST(l_partkey AS BIGINT) AS instrument,
       sum(l_quantity) AS quantity_sum,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(l_extendedprice) AS avg_cost,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS invested
FROM lineitem GROUP BY l_partkey
""")
def holdings_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    # The roll-up config's transformations: rename to the holdings vocabulary,
    # and a derived copy of a column (average_cost := avg_cost).
    df = apply_transformations(li, [
        {"column_name": "instrument", "expression": "l_partkey"},
        {"column_name": "quantity", "expression": "l_quantity"},
        {"column_name": "price", "expression": "cast(l_extendedprice as decimal(18,2))"},
        {"column_name": "average_cost", "expression": "price"},
    ], "lineitem")
    g = df.groupBy("instrument").agg(
        F.sum("quantity").alias("quantity_sum"),
        F.sum("average_cost").alias("_s"), F.count("average_cost").alias("_n"))
    return g.select(
        "instrument", "quantity_sum",
        (F.col("_s").cast("double") / F.col("_n")).alias("avg_cost"),
        F.col("_s").cast("double").alias("invested"))


_FLAG_KEY = "nullif(l_returnflag, 'R')"


@query("group_mean", "AGG-5 SRT-3", f"""
SELECT {_FLAG_KEY} AS flag, avg(l_quantity) AS mean_quantity
FROM lineitem WHERE {_FLAG_KEY} IS NOT NULL GROUP BY 1
""")
def group_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").withColumn("flag", F.expr(_FLAG_KEY))
    return S.summarize(li, ["flag"], [MeasureSpec("mean_quantity", "avg", "l_quantity")],
                       drop_null_keys=True, order_by_keys=True)


@query("group_sum", "AGG-6 SRT-3", f"""
SELECT {_FLAG_KEY} AS flag, sum(l_quantity) AS sum_quantity
FROM lineitem WHERE {_FLAG_KEY} IS NOT NULL GROUP BY 1
""")
def group_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").withColumn("flag", F.expr(_FLAG_KEY))
    return S.summarize(li, ["flag"], [MeasureSpec("sum_quantity", "sum", "l_quantity")],
                       drop_null_keys=True, null_sum_as_zero=True, order_by_keys=True)


@query("flag_summary", "AGG-1", """
SELECT l_returnflag, l_linestatus, count(*) AS n_lines,
       sum(l_quantity) AS sum_qty,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price,
       max(l_quantity) AS max_qty, min(l_quantity) AS min_qty
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def flag_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return S.summarize(li, ["l_returnflag", "l_linestatus"], [
        MeasureSpec("n_lines", "count_star"),
        MeasureSpec("sum_qty", "sum", "l_quantity"),
        MeasureSpec("sum_price", "sum", "l_extendedprice", cast="decimal(18,2)", out="double"),
        MeasureSpec("max_qty", "max", "l_quantity"),
        MeasureSpec("min_qty", "min", "l_quantity"),
    ])


@query("non_null_counts", "AGG-7 JON-1", """
SELECT count(d.doc_id) AS doc_id, count(d.lang) AS lang, count(d.source) AS source,
       count(d.n_chars) AS n_chars, count(l.quality) AS quality, count(l.toxic) AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def non_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return S.non_null_counts(left_join(docs, labels, ["doc_id"]))


@query("profile", "AGG-8", """
SELECT 's_acctbal' AS "column", count(s_acctbal) AS count, round(avg(s_acctbal), 8) AS mean,
       round(stddev_samp(s_acctbal), 8) AS std, min(s_acctbal) AS min,
       quantile_cont(s_acctbal, 0.25) AS p25, quantile_cont(s_acctbal, 0.5) AS p50,
       quantile_cont(s_acctbal, 0.75) AS p75, max(s_acctbal) AS max
FROM supplier
""")
def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.profile(table(spark, sf_dir, "supplier"), ["s_acctbal"], digits=8)


_LINEITEM_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("profile_lineitem", "AGG-8", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 8) AS mean,
       round(stddev_samp({c}), 8) AS std, min({c}) AS min,
       quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50,
       quantile_cont({c}, 0.75) AS p75, max({c}) AS max
FROM lineitem""" for c in _LINEITEM_MEASURES))
def profile_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Several columns in one pass of moments; quartiles per column from a
    # distributed value count (hundreds of thousands of distinct prices).
    return S.profile(table(spark, sf_dir, "lineitem"), list(_LINEITEM_MEASURES), digits=8)


@query("global_range", "AGG-9", """
SELECT min(o_totalprice) AS min_value, max(o_totalprice) AS max_value FROM orders
""")
def global_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.global_range(table(spark, sf_dir, "orders"), "o_totalprice")


@query("distinct_values", "AGG-10", "SELECT DISTINCT event_type FROM events")
def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.distinct_values(table(spark, sf_dir, "events"), "event_type")


@query("count_value", "AGG-11", """
SELECT count(*) FILTER (WHERE o_orderstatus = 'F') AS n_matching FROM orders
""")
def count_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.count_value(table(spark, sf_dir, "orders"), "o_orderstatus", "F")
