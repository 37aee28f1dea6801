"""Golden tests for the conform / align / summarise rules."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conformkit.operators import conform as C
from conformkit.operators import summarize as S
from conformkit.plans import mapping as M
from conformkit.sources import files as SRC
from conformkit.specs import MappingSpec, MeasureSpec, SpecError

BOM = "﻿"

# Three delivery feeds with different columns, and one table of parcels.  Each rule
# (name over alias, spelling of case, byte order mark, missing column) has a test of
# its own below.
FEEDS = {
    "depot": BOM + "route;stops;load_kg;opened\nN1;4;12.5;2024-03-01\nN1;6;7.25;2024-03-02\nS2;3;;2024-03-02\n",
    "van": "Plate,ROUTE,Load_KG\nAB-12,N1,3\nAB-13,W9,100\n",
    "bike": "rider,route_code\nIda,W9-east\n",
}


def parcels(write_text_file, **changes) -> MappingSpec:
    def source(name, transformations, **more):
        return {"source_name": name, "path": write_text_file(f"{name}.csv", FEEDS[name]),
                "transformations": [{"column_name": c, "expression": e} for c, e in transformations], **more}

    spec = {
        "data_sources": [
            source("depot", [("kg", "coalesce(cast(load_kg as double), 0)"), ("stops", "stops * 2 - 1"),
                             ("day", "substring(opened, 1, 10) as opened_on")], options={"sep": ";"}),
            source("van", [("route", "concat(route, '/', substring(plate, 1, 2))"), ("kg", "load_kg")]),
            source("bike", [("route", "substring(route_code, 1, 2)"), ("carrier", "upper(rider)"), ("kg", "0.5")]),
        ],
        "columns": [{"col_name": n, "col_type": t} for n, t in (
            ("day", "date"), ("route", "string"), ("kg", "double"), ("stops", "bigint"), ("carrier", "string"))],
        "keys": ["route"],
        "measures": [{"name": "n", "func": "count_star"}, {"name": "kg", "func": "sum", "column": "kg"},
                     {"name": "heaviest", "func": "max", "column": "kg"}],
    }
    return MappingSpec.from_dict({**spec, **changes})


def test_sources_are_matched_by_name_and_missing_columns_are_null(spark, write_text_file):
    rows = M.conformed(spark, parcels(write_text_file))
    assert rows.columns == ["day", "route", "kg", "stops", "carrier"]
    assert {(str(r.day), r.route, r.kg, r.stops, r.carrier) for r in rows.collect()} == {  # D1, D11
        ("2024-03-01", "N1", 12.5, 7, None), ("2024-03-02", "N1", 7.25, 11, None), ("2024-03-02", "S2", 0.0, 5, None),
        ("None", "N1/AB", 3.0, None, None), ("None", "W9/AB", 100.0, None, None), ("None", "W9", 0.5, None, "IDA")}


def test_summary_compares_text_numbers_as_numbers(spark, write_text_file):
    # D2: the feeds' weights are text; as text 7.25 is above 12.5 and 100.
    got = {r.route: (r.n, r.kg, r.heaviest) for r in M.summary(spark, parcels(write_text_file)).collect()}
    assert got["N1"] == (2, 19.75, 12.5) and got["W9/AB"] == (1, 100.0, 100.0)


def test_bom_is_dropped_from_first_header(spark, write_text_file):
    df = SRC.read_source(spark, parcels(write_text_file).sources[0])
    assert df.columns == ["route", "stops", "load_kg", "opened"]  # D22


def test_column_name_wins_over_an_alias(spark, write_text_file):
    depot = M.transformed_sources(spark, parcels(write_text_file))[0][1]
    assert depot.columns == ["route", "stops", "load_kg", "opened", "kg", "day"]  # D8: no opened_on


def test_case_insensitive_match_keeps_place_and_takes_new_spelling(spark, write_text_file):
    van = M.transformed_sources(spark, parcels(write_text_file))[1][1]
    assert van.columns == ["Plate", "route", "Load_KG", "kg"]  # D9


def test_case_duplicate_headers_are_refused(spark, write_text_file):
    df = spark.createDataFrame([(1, 2, 3)], "id int, a int, b int").toDF("id", "Tone", "tone")
    with pytest.raises(C.ConformError, match="differ only by case"):
        C.check_case_unique(df, "dup")
    # The CSV reader itself renames such headers (Tone1, tone2), so a mapping
    # that refers to `tone` fails loudly at plan time, naming the source.
    path = write_text_file("dup.csv", "id,Tone,tone\n1,2,3\n")
    csv = SRC.read_csv_strings(spark, path)
    with pytest.raises(C.ConformError, match="source 'dup'"):
        C.apply_transformations(csv, [{"column_name": "tone", "expression": "tone"}], "dup")


def test_transformations_run_in_order_and_collapse_to_one_project(spark):
    df = spark.range(3).withColumn("x", F.lit(1))
    out = C.apply_transformations(df, [
        {"column_name": "x", "expression": "x + 1"},
        {"column_name": "y", "expression": "x * 10"},
        {"column_name": "x", "expression": "x + 1"},   # repeated name: applied again
        {"column_name": "z", "expression": "y + x"},
    ])
    r = out.first()
    assert (r.x, r.y, r.z) == (3, 20, 23)  # D10
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") == 1


def test_bad_expression_names_source_and_column(spark):
    with pytest.raises(C.ConformError, match="source 'S1', column 'y'"):
        C.apply_transformations(spark.range(1), [{"column_name": "y", "expression": "no_such + 1"}], "S1")


def test_typed_nulls_can_be_written_as_csv(spark, tmp_path):
    df = C.conform_to(spark.range(2), T.StructType([
        T.StructField("id", T.LongType()), T.StructField("missing", T.IntegerType())]))
    assert df.schema["missing"].dataType == T.IntegerType()  # D11
    df.write.csv(str(tmp_path / "out"), header=True)


def test_align_to_target_casts_renames_and_fills(spark):
    src = spark.createDataFrame([("7", "x", 1.239)], "ID string, extra string, AMT double")
    target = T.StructType([
        T.StructField("id", T.IntegerType()), T.StructField("amt", T.DecimalType(10, 2)),
        T.StructField("note", T.StringType())])
    out = C.align_to_target(src, target)
    assert out.schema == T.StructType([
        T.StructField("id", T.IntegerType(), True), T.StructField("amt", T.DecimalType(10, 2), True),
        T.StructField("note", T.StringType(), True)])
    r = out.first()
    assert (r.id, str(r.amt), r.note) == (7, "1.24", None)  # D3, D4


def test_align_safe_cast_and_rejects(spark):
    src = spark.createDataFrame([("1",), ("oops",), (None,)], "id string")
    target = T.StructType([T.StructField("id", T.IntegerType())])
    assert [r.id for r in C.align_to_target(src, target, safe_cast=True).collect()] == [1, None, None]
    rej = C.cast_rejects(src, target).collect()
    assert [(r.id, r.rejected_columns) for r in rej] == [("oops", ["id"])]


def test_mixed_types_are_conformed_before_union(spark):
    a = spark.createDataFrame([(1,)], "v int")
    b = spark.createDataFrame([("2",)], "v string")
    out = C.conform_and_union([("a", a), ("b", b)], [("v", "bigint")])
    assert sorted(r.v for r in out.collect()) == [1, 2]  # D23
    assert out.schema["v"].dataType == T.LongType()


def test_union_has_no_empty_seed_scan(spark):
    a, b = spark.range(2), spark.range(3)
    plan = C.union_conformed([a, b])._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" not in plan and plan.count("Range") == 2


def test_explicit_schema_with_malformed_cell_and_rejects(spark, write_text_file):
    path = write_text_file("typed.csv", "id,amount\n1,2.5\n2,abc\n")
    schema = [("id", "int"), ("amount", "double")]
    rows = SRC.read_csv_typed(spark, path, schema, keep_rejects=True).collect()
    assert [(r.id, r.amount) for r in rows] == [(1, 2.5), (2, None)]  # D12
    assert [r._corrupt_record for r in rows] == [None, "2,abc"]


def test_header_disagreeing_with_schema_fails(spark, write_text_file):
    path = write_text_file("swapped.csv", "amount,id\n2.5,1\n")
    with pytest.raises(Exception, match="(?i)header|CSV"):
        SRC.read_csv_typed(spark, path, [("id", "int"), ("amount", "double")]).collect()


def test_ddl_read_with_explicit_header_skips_it(spark, write_text_file):
    path = write_text_file("ddl.csv", "Index,name\n1,a\n")
    assert SRC.read_csv_ddl(spark, path, "Index INT, name STRING", header=True).count() == 1
    rows = SRC.read_csv_ddl(spark, path, "Index INT, name STRING", header=False).collect()
    assert rows[0].Index is None  # D13: the header became a row


def test_pandas_style_group_options(spark):
    df = spark.createDataFrame([("a", None), ("a", None), (None, 1.0), ("b", 2.0)], "k string, v double")
    spark_like = {r.k: r.s for r in S.summarize(df, ["k"], [MeasureSpec("s", "sum", "v")]).collect()}
    assert spark_like == {"a": None, None: 1.0, "b": 2.0}
    pandas_like = S.summarize(df, ["k"], [MeasureSpec("s", "sum", "v")],
                              drop_null_keys=True, null_sum_as_zero=True, order_by_keys=True)
    assert [(r.k, r.s) for r in pandas_like.collect()] == [("a", 0.0), ("b", 2.0)]  # D17


def test_profile_interpolates_quartiles(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4)], "x double")
    r = S.profile(df).first()
    assert (r["count"], r.mean, r.min, r.max) == (4, 2.5, 1.0, 4.0)
    assert (r.p25, r.p50, r.p75) == (1.75, 2.5, 3.25)  # D18
    approx = S.profile(df, exact=False).first()
    assert approx.p50 in (2.0, 3.0)


def test_measure_report_matches_separate_aggregates(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 2.0)], "k string, v double")
    rep = S.measure_report(df, ["k"], {"c": [MeasureSpec("n", "count_star")],
                                       "m": [MeasureSpec("hi", "max", "v"), MeasureSpec("lo", "min", "v")]})
    got = {(r.k, r.measure_set, r.measure): r.value for r in rep.collect()}
    assert got == {("a", "c", "n"): 2.0, ("b", "c", "n"): 1.0, ("a", "m", "hi"): 3.0,
                   ("a", "m", "lo"): 1.0, ("b", "m", "hi"): 2.0, ("b", "m", "lo"): 2.0}
    # one aggregate, so one shuffle
    plan = rep._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1


def test_optional_missing_source_is_empty_but_other_errors_raise(spark, tmp_path):
    from conformkit.specs import SourceSpec
    spec = SourceSpec("late", str(tmp_path / "absent"), "parquet", schema="a INT", optional=True)
    assert SRC.read_source(spark, spec).count() == 0
    with pytest.raises(SpecError):
        SRC.read_source(spark, SourceSpec("late", str(tmp_path / "absent"), "parquet", optional=True))


def test_undeclared_schema_is_first_seen_order_and_common_type(spark):
    a = spark.createDataFrame([(1, "x")], "id bigint, name string")
    b = spark.createDataFrame([("2", 5.0, "y")], "ID string, score double, name string")
    out = C.conform_and_union([("a", a), ("b", b)])
    assert [(f.name, f.dataType.simpleString()) for f in out.schema.fields] == [
        ("id", "string"), ("name", "string"), ("score", "double")]  # text holds both ids
    assert sorted((r.id, r.name, r.score) for r in out.collect()) == [("1", "x", None), ("2", "y", 5.0)]


def test_a_feed_with_only_a_header_adds_no_rows(spark, write_text_file):
    spec = MappingSpec.from_dict({
        "data_sources": [
            {"source_name": "quiet", "path": write_text_file("quiet.csv", BOM + "seal,height\n"),
             "transformations": [{"column_name": "height", "expression": "height / 100"}]},
            {"source_name": "busy", "path": write_text_file("busy.csv", "seal,height\nx,250\n")}],
        "columns": [{"col_name": "height", "col_type": "double"}],
        "measures": [{"name": "n", "func": "count_star"}, {"name": "top", "func": "max", "column": "height"}]})
    assert [tuple(r) for r in M.summary(spark, spec).collect()] == [(1, 250.0)]


def test_keys_and_measures_can_come_from_the_job(spark, write_text_file):
    bare = parcels(write_text_file, keys=[], measures=[])
    with pytest.raises(SpecError, match="measures"):
        M.summary(spark, bare)
    out = M.summary(spark, bare, keys=["day"], measures=[MeasureSpec("n", "count"), MeasureSpec("most", "max", "stops")])
    assert sorted((str(r.day), r.n, r.most) for r in out.collect()) == [
        ("2024-03-01", 1, 7), ("2024-03-02", 2, 11), ("None", 3, None)]


def test_many_independent_transformations_batch_into_one_projection(spark):
    import time
    df = spark.range(5).withColumn("base", F.col("id") * 2)
    ts = [{"column_name": f"c{i}", "expression": f"base + {i}"} for i in range(300)]
    ts += [{"column_name": "total", "expression": "c0 + c299"},     # reads this batch: new run
           {"column_name": "BASE", "expression": "base * 10"}]     # redefines: same position
    t0 = time.time()
    out = C.apply_transformations(df, ts)
    assert time.time() - t0 < 30
    r = out.filter("id = 1").first()
    assert (r.c0, r.c299, r.total, r.BASE) == (2, 301, 303, 20)
    assert out.columns[:2] == ["id", "BASE"]
    assert C._batches([C.Transform(t["column_name"], t["expression"]) for t in ts]).__len__() == 2


def test_batching_keeps_sequential_meaning():
    from conformkit.specs import Transform
    runs = C._batches([Transform("x", "x + 1"), Transform("y", "X * 10"), Transform("z", "q * 2"),
                       Transform("w", "struct(*)"), Transform("x", "1"), Transform("v", "count(*)")])
    assert [[t.column_name for t in r] for r in runs] == [["x"], ["y", "z"], ["w", "x"], ["v"]]
