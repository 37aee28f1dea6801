"""Rules at the edges: layouts of loads, JSON documents, names, NaN and map columns."""

from __future__ import annotations

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conformkit.operators import ordering as O
from conformkit.operators import summarize as S
from conformkit.plans.load import load
from conformkit.sinks import files as SNK
from conformkit.specs import LoadSpec, LoadType, SpecError

DAY = dt.date(2024, 1, 15)


def test_full_then_incremental_keeps_every_other_row(spark, tmp_path):
    rows = [(1, DAY), (2, DAY), (3, dt.date(2024, 1, 1)), (4, None)]
    df = spark.createDataFrame(rows, "id int, load_date date")
    full = LoadSpec(str(tmp_path / "t"), incremental_column="load_date")
    load(spark, df, full, DAY)
    step = dataclasses.replace(full, load_type=LoadType.INCREMENTAL)
    for _ in range(2):
        load(spark, spark.createDataFrame([(9, DAY)], "id int, load_date date"), step, DAY)
    assert {(r.id, r.load_date) for r in spark.read.parquet(full.target).collect()} == {
        (3, dt.date(2024, 1, 1)), (4, None), (9, DAY)}


def test_incremental_refuses_another_layout(spark, tmp_path):
    df = spark.createDataFrame([(1, DAY)], "id int, load_date date")
    df.write.parquet(str(tmp_path / "t"))
    with pytest.raises(SpecError):
        load(spark, df, LoadSpec(str(tmp_path / "t"), LoadType.INCREMENTAL, "load_date"), DAY)
    with pytest.raises(SpecError):
        LoadSpec("t", incremental_column="a", partition_by=("b",))


def test_json_documents_keep_every_record(spark, tmp_path):
    df = spark.range(10, numPartitions=2).selectExpr("id", "concat('x', id) as name")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 3)
    try:
        SNK.write_json_documents(df, str(tmp_path / "j"), document_bytes=100)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    back = spark.read.schema("id long, name string").json(str(tmp_path / "j"), multiLine=True, mode="FAILFAST")
    assert sorted((r.id, r.name) for r in back.collect()) == [(i, f"x{i}") for i in range(10)]


def test_measures_ignore_case_and_pandas_keys_drop_nan(spark):
    df = spark.createDataFrame([(1.0, 5), (float("nan"), 7), (None, 8)], "k double, Weight int")
    rows = S.summarize(df, ["k"], [{"name": "n", "func": "sum", "column": "weight"}], drop_null_keys=True).collect()
    assert [(r.k, r.n) for r in rows] == [(1.0, 5)]
    with pytest.raises(SpecError):
        S.summarize(df, ["k"], [{"name": "n", "func": "sum", "column": "height"}])


def test_sort_with_a_map_column_is_ordered(spark):
    df = spark.createDataFrame([(2, {"a": 1}), (1, {"b": 2}), (2, {})], "k int, m map<string,int>")
    assert [r.k for r in O.sort_rows(df, ["k"]).collect()] == [1, 2, 2]


def test_derived_schema_widens(spark):
    from conformkit.operators.conform import ConformError, conform_and_union

    a = spark.createDataFrame([(1, 2, None)], "k int, v int, n void")
    b = spark.createDataFrame([("x", 2.5, 7)], "K string, v double, n long")
    for frames in ([("a", a), ("b", b)], [("b", b), ("a", a)]):
        out = conform_and_union(frames)
        assert [t for _, t in out.dtypes] == ["string", "double", "bigint"]
        assert {tuple(r) for r in out.collect()} == {("1", 2.0, None), ("x", 2.5, 7)}
    with pytest.raises(ConformError, match="no common type"):
        conform_and_union([("a", a), ("c", spark.createDataFrame([([1],)], "k array<int>"))])


def test_slice_is_counted_by_its_write(spark, tmp_path):
    from conformkit.plans.load import incremental_replace_files

    target = str(tmp_path / "t")
    rows = spark.range(5).withColumn("day", F.lit(None).cast("date"))
    for df, n in ((rows, 5), (rows.where("id < 2"), 2), (rows.where("id < 0"), 0), (rows.where("false"), 0)):
        assert incremental_replace_files(spark, rows.limit(3), target, "day", "2024-01-01").rows_in_slice == 3
        assert incremental_replace_files(spark, df, target, "day", "2024-01-02").rows_in_slice == n
        found = spark.read.schema("id long, day date").parquet(target).groupBy("day").count().collect()
        assert {str(r["day"]): r["count"] for r in found} == {"2024-01-01": 3} | ({"2024-01-02": n} if n else {})


def test_rejects_are_replaced_per_run_date(spark, tmp_path):
    from conformkit.plans.jobs import JobSpec, run_jobs
    from conformkit.specs import LoadSpec

    rejects = str(tmp_path / "rejects")
    job = JobSpec("j", lambda s, d: s.createDataFrame([("1",), ("oops",)], "n string"),
                  LoadSpec(str(tmp_path / "out")), target_schema=T.StructType([T.StructField("n", T.IntegerType())]),
                  safe_cast=True, reject_path=rejects)
    for day in ("2024-01-01", "2024-01-01", "2024-01-02"):
        run_jobs(spark, [job], day)
    assert spark.read.parquet(rejects).count() == 2


def test_folders_inside_each_other_are_the_same_location():
    from conformkit.plans.jobs import _same_location

    assert _same_location("file:/d/a", "/d/a/") and _same_location("/d/a", "/d/a/day=1")
    assert not _same_location("/d/A", "/d/a") and not _same_location("/d/a", "/d/ab")


def test_table_names_and_sql_are_told_apart():
    from conformkit.sources.jdbc import subquery
    from conformkit.specs import ConnectionProfile

    for name in ("withdrawals", "selections", "dbo.with_x", '"My Schema"."t 1"', "[a b].[c]"):
        assert subquery(name) == name
    assert subquery("-- all\nselect 1 -- end;") == "(-- all\nselect 1 -- end\n) src"
    assert subquery("(select 1) t") == "(select 1) t"
    p = ConnectionProfile.from_dict({"url": "jdbc:x", "fetchsize": 5, "ssl": "true"})
    assert p.jdbc_options() == {"url": "jdbc:x", "fetchsize": "5", "ssl": "true"}


def test_ordered_queries_come_in_order(spark):
    from conformkit.plans.catalog import queries

    def rows(name):
        return [tuple(r) for r in queries()[name](spark, "/root/testdata/sf0.001").collect()]

    assert rows("sort_rows") == sorted(rows("sort_rows"), key=lambda r: (r[1], r[0]))
    assert rows("top_rows") == sorted(rows("top_rows"), key=lambda r: (-r[1], r[0]))
    assert rows("preview") == sorted(rows("preview"), key=lambda r: (r[1], r[0]))
    for name in ("group_mean", "group_sum"):
        keys = [r[0] for r in rows(name)]
        assert len(keys) > 1 and keys == sorted(keys)
