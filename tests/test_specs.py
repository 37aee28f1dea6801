"""Config parsing in the reference's shapes (mapping, roll-up, load, services,
connection profiles) and the JDBC option rules that need no database."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import types as T

from conformkit.sources import jdbc as JDBC
from conformkit.sources.files import read_config
from conformkit.specs import (
    ConnectionProfile,
    LoadSpec,
    LoadType,
    MappingSpec,
    SpecError,
    build_schema,
    parse_type,
    profiles_from,
)


def test_type_names_from_config(spark):
    assert parse_type("INT") == T.IntegerType()
    assert parse_type("double") == T.DoubleType()
    assert parse_type("Date") == T.DateType()
    assert parse_type("decimal(18,2)") == T.DecimalType(18, 2)
    assert parse_type("no such type") == T.StringType()


def test_schema_from_roll_up_config(spark):
    schema = build_schema([{"col_name": "instrument", "col_type": "string"},
                           {"col_name": "quantity", "col_type": "int"},
                           {"col_name": "avg_cost", "col_type": "double"}])
    assert [(f.name, f.dataType, f.nullable) for f in schema.fields] == [
        ("instrument", T.StringType(), True), ("quantity", T.IntegerType(), True),
        ("avg_cost", T.DoubleType(), True)]
    with pytest.raises(SpecError):
        build_schema([("a", "int"), ("A", "int")])


def test_mapping_config_shape():
    spec = MappingSpec.from_dict({
        "data_sources": [
            {"source_name": "TN", "path": "a.csv", "transformations": [
                {"column_name": "x", "expression": "trim(x)"},
                {"column_name": "source_key", "expression": "'TN'"}]},
            {"source_name": "KL", "path": "b.csv", "transformations": [
                {"column_name": "X", "expression": "x"},
                {"column_name": "contact", "expression": "contact"}]}],
        "output_path": "out/"})
    assert [s.name for s in spec.sources] == ["TN", "KL"]
    assert spec.transformation_columns() == ["x", "source_key", "contact"]
    assert spec.output_path == "out/"
    with pytest.raises(SpecError):
        MappingSpec.from_dict({"data_sources": []})
    with pytest.raises(SpecError):
        MappingSpec.from_dict({"data_sources": [{"source_name": "A"}, {"source_name": "A"}]})


def test_load_config_shape():
    spec = LoadSpec.from_dict({"targetTable": "T1", "load_type": "incremental",
                               "incremental_column": "mis_date",
                               "transformations": [{"column_name": "mis_date",
                                                    "expression": "current_date() - 1"}]})
    assert spec.load_type is LoadType.INCREMENTAL and spec.incremental_column == "mis_date"
    assert LoadSpec.from_dict({"targetTable": "T1", "load_type": "FULL"}).load_type is LoadType.FULL
    with pytest.raises(SpecError, match="slice_mode"):
        LoadSpec.from_dict({"targetTable": "T1", "slice_mode": "daily"})
    with pytest.raises(SpecError, match="targetTable"):
        LoadSpec.from_dict({"load_type": "full"})


def test_profiles_read_password_from_environment(monkeypatch):
    monkeypatch.setenv("TGT_PW", "s3cret")
    profiles = profiles_from({
        "target_db_configs": {"url": "jdbc:x://h/db", "user": "u", "password_env": "TGT_PW",
                              "driver": "x.Driver", "connection_name": "tgt"},
        "source_db_configs": {"url": "jdbc:y://h/db", "user": "v", "password": "inline"}})
    assert profiles["tgt"] is profiles["target_db_configs"]
    assert profiles["tgt"].jdbc_options() == {"url": "jdbc:x://h/db", "driver": "x.Driver",
                                              "user": "u", "password": "s3cret"}
    assert "s3cret" not in repr(profiles["tgt"])
    assert profiles["source_db_configs"].resolved_password() == "inline"


def test_config_file_read_through_spark(spark, write_text_file):
    path = write_text_file("cfg.json", json.dumps({"services": ["a.B"]}, indent=2))
    assert read_config(spark, path) == {"services": ["a.B"]}
    bad = write_text_file("bad.json", "{not json")
    with pytest.raises(SpecError):
        read_config(spark, bad)
    with pytest.raises(SpecError, match="does not exist"):
        read_config(spark, path + ".missing")
    bom = write_text_file("bom.json", "\ufeff" + json.dumps({"a": 1}))
    assert read_config(spark, bom) == {"a": 1}


def test_jdbc_query_is_wrapped_as_subquery():
    assert JDBC.subquery("select a from t;") == "(select a from t) src"
    assert JDBC.subquery("  WITH x AS (select 1) select * from x") .startswith("(WITH")
    assert JDBC.subquery("schema.table") == "schema.table"


def test_jdbc_range_read_needs_all_four_options(spark):
    p = ConnectionProfile(url="jdbc:none:nowhere")
    with pytest.raises(SpecError, match="together"):
        JDBC.read_query(spark, p, "select 1", partition_column="id", num_partitions=4)
    with pytest.raises(SpecError, match="either"):
        JDBC.read_query(spark, p, "select 1", partition_column="id", predicates=["a=1"])


def test_unsafe_identifiers_are_refused():
    from conformkit.specs import check_identifier
    assert check_identifier("public.cargo_days") == "public.cargo_days"
    for bad in ("t; drop table x", "a b", "", "1abc", "t--"):
        with pytest.raises(SpecError):
            check_identifier(bad)
