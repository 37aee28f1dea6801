"""Plan tests: the physical plans are the ones we want (pruning, pushdown, shuffles)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

import __spark_entry__ as E
from conformkit.plans import load as L

SF = "/root/testdata/sf0.01"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rollup_prunes_columns_and_shuffles_once(spark):
    df = E.queries()["holdings_rollup"](spark, SF)
    plan = _plan(df)
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_extendedprice:double>" in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert "HashAggregate" in plan


def test_mapping_summary_unions_without_shuffle_and_aggregates_once(spark):
    plan = _plan(E.queries()["mapping_summary"](spark, SF))
    assert plan.count("Exchange") == 1
    assert "Union" in plan
    # Columns the summary does not use (name, key, segment) are never read.
    assert "ReadSchema: struct<c_nationkey:int,c_acctbal:double>" in plan
    assert "ReadSchema: struct<s_nationkey:int,s_acctbal:double>" in plan


def test_word_positions_need_no_key_shuffle(spark):
    plan = _plan(E.queries()["words_with_prefix"](spark, SF))
    # Numbering happens in the task holding the row: no window, no shuffle by key.
    assert "Exchange" not in plan and "Window" not in plan
    assert "Generate" in plan and "posexplode" in plan


def test_top_rows_is_a_per_task_top_n(spark):
    plan = _plan(E.queries()["top_rows"](spark, SF))
    assert "TakeOrderedAndProject" in plan


def test_filters_reach_the_parquet_scan(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    df = li.filter(F.col("l_returnflag") == "R").select("l_orderkey")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in plan


def test_incremental_target_reads_prune_partitions(spark, tmp_path):
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("load_date", F.col("ts").cast("date"))
    target = str(tmp_path / "daily")
    L.full_load_files(ev, target, partition_by=("load_date",))
    day = dt.date(2024, 1, 15)
    df = spark.read.parquet(target).filter(F.col("load_date") == F.lit(day))
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(load_date" in plan
    assert {r.load_date for r in df.select("load_date").distinct().collect()} == {day}


def test_transform_chain_is_one_codegen_stage(spark):
    plan = _plan(E.queries()["string_basics"](spark, SF))
    assert "Exchange" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_aggregates_combine_before_the_shuffle(spark):
    # A key holding a third of the rows leaves each map task as ONE partial row.
    plan = _plan(E.queries()["mapping_summary"](spark, SF))
    before_exchange = plan.split("Exchange hashpartitioning")[1]
    assert "partial_count" in before_exchange and "partial_sum" in before_exchange


def test_left_join_carries_no_hint(spark):
    df = E.queries()["left_join"](spark, SF)
    logical = df._jdf.queryExecution().logical().toString()
    assert "broadcast" not in logical.lower()


def test_slice_filter_on_a_derived_date_reaches_the_scan(spark):
    # `cast(ts as date) = day`, written on the transformed column, is turned
    # into a range on `ts` and pushed into Parquet, so row groups outside the
    # day are skipped by their statistics.
    from conformkit.plans.jobs import JobSpec, plan_job
    from conformkit.specs import LoadSpec, SourceSpec
    spec = LoadSpec.from_dict({
        "targetTable": "/nonexistent/target", "load_type": "incremental",
        "incremental_column": "load_date", "slice_mode": "slice",
        "transformations": [{"column_name": "load_date", "expression": "cast(ts as date)"}]})
    job = JobSpec("ev", SourceSpec("ev", f"{SF}/events.parquet", "parquet"), spec)
    plan = _plan(plan_job(spark, job, dt.date(2024, 1, 15)).frame)
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in plan and "LessThan(ts,2024-01-16T00:00)" in plan


def test_global_sort_splits_a_hot_key(spark):
    from conformkit.operators.ordering import sort_rows
    # 1/3 of the rows share one sort key; the hidden tie-breaker lets the range
    # partitioner spread them, and the key order is still respected.
    df = spark.range(30000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        def largest(split):
            out = sort_rows(df, ["k"], split_ties=split).select("k", "id")
            return max(len(p) for p in out.rdd.glom().collect()), [r.k for r in out.collect()]
        plain, _ = largest(False)
        split, ks = largest(True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert plain >= 10000 > split
    assert ks == sorted(ks)
