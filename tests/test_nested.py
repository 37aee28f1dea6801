"""Alignment of nested columns by field name, against plain Python values."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conformkit.operators import conform as C


def schema(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)


def plain(v):
    if isinstance(v, T.Row):
        return {k: plain(x) for k, x in v.asDict().items()}
    if isinstance(v, list):
        return [plain(x) for x in v]
    if isinstance(v, dict):
        return {k: plain(x) for k, x in v.items()}
    return v


def test_struct_fields_match_by_name_not_position(spark):
    df = spark.createDataFrame([((1, 2),), (None,)], "s struct<a:int,b:int>")
    out = C.align_to_target(df, schema("s struct<b:int,a:int>"))
    assert [plain(r.s) for r in out.collect()] == [{"b": 2, "a": 1}, None]


def test_missing_nested_fields_are_typed_nulls_and_extras_go(spark):
    df = spark.createDataFrame([((1, 2),)], "s struct<a:int,b:int>")
    out = C.align_to_target(df, schema("s struct<B:string, c:date, d:struct<e:array<int>>>, t map<string,int>"))
    assert out.schema.simpleString() == "struct<s:struct<B:string,c:date,d:struct<e:array<int>>>,t:map<string,int>>"
    assert plain(out.first()) == {"s": {"B": "2", "c": None, "d": None}, "t": None}


DEEP = ("id bigint, o struct<lines:array<struct<QTY:string,sku:string,tags:map<string,struct<w:int,h:int>>>>,"
        "note:string>, m map<string,array<struct<x:int,y:int>>>")
DEEP_TARGET = ("id int, o struct<note:string,lines:array<struct<sku:string,qty:int,"
               "tags:map<string,struct<h:double,w:bigint,d:string>>>>>, m map<string,array<struct<y:string,x:int>>>")


def test_arrays_and_maps_of_structs(spark):
    rows = [
        (1, {"lines": [{"QTY": "4", "sku": "p", "tags": {"k": {"w": 1, "h": 2}}}, None, {"QTY": None, "sku": "q", "tags": None}],
             "note": "n"}, {"m": [{"x": 1, "y": 2}, None], "e": [], "z": None}),
        (2, None, None), (3, {"lines": None, "note": None}, {})]
    df = spark.createDataFrame(rows, schema(DEEP))
    for safe in (False, True):
        out = C.align_to_target(df, schema(DEEP_TARGET), safe_cast=safe)
        assert out.schema.simpleString() == schema(DEEP_TARGET).simpleString()
        got = {r.id: plain(r) for r in out.collect()}
        assert got[1]["o"] == {"note": "n", "lines": [
            {"sku": "p", "qty": 4, "tags": {"k": {"h": 2.0, "w": 1, "d": None}}}, None, {"sku": "q", "qty": None, "tags": None}]}
        assert got[1]["m"] == {"m": [{"y": "2", "x": 1}, None], "e": [], "z": None}
        assert got[2] == {"id": 2, "o": None, "m": None} and got[3] == {"id": 3, "o": {"note": None, "lines": None}, "m": {}}


def test_nested_rejects_name_the_path(spark):
    rows = [(1, {"lines": [{"QTY": "4", "sku": "a", "tags": {}}, {"QTY": "many", "sku": "b", "tags": {}}], "note": ""}, None),
            (2, {"lines": [{"QTY": "5", "sku": "a", "tags": None}], "note": ""}, {}), (3, None, None)]
    df = spark.createDataFrame(rows, schema(DEEP))
    bad = C.cast_rejects(df, schema(DEEP_TARGET)).collect()
    assert [(r.id, r.rejected_columns) for r in bad] == [(1, ["o.lines[].qty"])]
    out = C.align_to_target(df, schema(DEEP_TARGET), safe_cast=True)
    assert [x.qty for x in out.filter("id = 1").first().o.lines] == [4, None]


def test_map_keys_that_meet_are_refused(spark):
    df = spark.createDataFrame([(1, {"1": "a", "01": "b"}), (2, {"7": "c", "8": "x"}), (3, {"one": "d"}), (4, None), (5, {})],
                               "id int, m map<string,string>")
    target = schema("id int, m map<int,string>")
    got = {r.id: r.m for r in C.align_to_target(df, target, safe_cast=True).collect()}
    assert got == {1: None, 2: {7: "c", 8: "x"}, 3: None, 4: None, 5: {}}
    assert sorted((r.id, r.rejected_columns) for r in C.cast_rejects(df, target).collect()) == [(1, ["m{key}"]), (3, ["m{key}"])]


@pytest.mark.parametrize("source,target", [("s string", "s struct<a:int>"), ("s struct<a:int>", "s int"),
                                           ("s array<int>", "s map<int,int>"), ("s struct<a:array<int>>", "s struct<a:struct<b:int>>")])
def test_kinds_that_do_not_fit_are_refused_at_planning(spark, source, target):
    with pytest.raises(C.ConformError, match="does not become"):
        C.align_to_target(spark.createDataFrame([], schema(source)), schema(target))


def test_ambiguous_nested_names_are_refused(spark):
    df = spark.range(1).select(F.struct(F.lit(1).alias("a"), F.lit(2).alias("A")).alias("s"))
    with pytest.raises(C.ConformError, match="ambiguous"):
        C.align_to_target(df, schema("s struct<a:bigint>"))


def test_a_struct_becomes_text_and_nullability_is_no_difference(spark):
    df = spark.createDataFrame([((1,), [1])], "s struct<a:int>, v array<int>")
    out = C.align_to_target(df, T.StructType([T.StructField("s", T.StringType()),
                                              T.StructField("v", T.ArrayType(T.IntegerType(), False))]))
    assert plain(out.first()) == {"s": "{1}", "v": [1]}
    assert "cast" not in out._jdf.queryExecution().analyzed().toString().split("v#")[-1]


def test_derived_schema_merges_nested_fields(spark):
    a = spark.createDataFrame([((1, "x"), [(1,)])], "s struct<id:int,name:string>, v array<struct<q:int>>")
    b = spark.createDataFrame([((2.5, "c", "y"), [("t", 2)])], "S struct<ID:double,code:string,name:string>, v array<struct<r:string,Q:bigint>>")
    out = C.conform_and_union([("a", a), ("b", b)])
    assert out.schema.simpleString() == ("struct<s:struct<id:double,name:string,code:string>,v:array<struct<q:bigint,r:string>>>")
    assert sorted(json.dumps(plain(r)) for r in out.collect()) == sorted(map(json.dumps, [
        {"s": {"id": 1.0, "name": "x", "code": None}, "v": [{"q": 1, "r": None}]},
        {"s": {"id": 2.5, "name": "y", "code": "c"}, "v": [{"q": 2, "r": "t"}]}]))


def test_alignment_is_one_projection(spark):
    df = spark.createDataFrame([], schema(DEEP))
    plan = C.align_to_target(df.repartition(2), schema(DEEP_TARGET))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") == 1 and "Generate" not in plan and "Aggregate" not in plan
