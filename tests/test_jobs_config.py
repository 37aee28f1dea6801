"""Config-file entry points: mapping file, roll-up file, services file."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from conformkit.plans.jobs import JobSpec, run_services, service
from conformkit.plans.mapping import load_mapping, run_mapping
from conformkit.plans.rollup import RollupSpec, run_rollup
from conformkit.specs import LoadSpec, MeasureSpec, SourceSpec

PUMPS = (
    "station,litres,bar\n"
    "north,10,2.5\n"
    "north,5,1.5\n"
    "south,7,4.0\n"
    "south,oops,5.0\n"
)

ROLLUP_CONFIG = {"pumps": {
    "sourceCSVPath": None, "targetTable": "pump_days",
    "readSchema": [{"col_name": "station", "col_type": "string"},
                   {"col_name": "litres", "col_type": "int"},
                   {"col_name": "bar", "col_type": "double"}],
    "transformations": [
        {"column_name": "kilopascal", "expression": "bar * 100"},
        {"column_name": "read_on", "expression": "date'2024-02-01'"}],
    "read_db_tables": {"limits": "select station, max_bar from pump_limits"}}}


def test_rollup_from_config_file(spark, write_text_file):
    cfg = json.loads(json.dumps(ROLLUP_CONFIG))
    cfg["pumps"]["sourceCSVPath"] = write_text_file("pumps.csv", PUMPS)
    path = write_text_file("rollup.json", json.dumps(cfg))
    spec = RollupSpec.from_dict(cfg)
    assert spec.target == "pump_days" and "limits" in spec.db_queries
    out = run_rollup(spark, path, ["station"], [
        MeasureSpec("total", "sum", "litres"),
        MeasureSpec("pressure", "avg", "kilopascal")], order_by_keys=True)
    got = [(r.station, r.total, r.pressure) for r in out.collect()]
    # The malformed number reads as null (not a failed job), so south sums 7.
    assert got == [("north", 15, 200.0), ("south", 7, 450.0)]


def test_mapping_from_config_file_writes_csv(spark, write_text_file, tmp_path):
    a = write_text_file("a.csv", "id,v\n1,10\n1,5\n2,7\n")
    b = write_text_file("b.csv", "ID,value,extra\n2,1,x\n")
    cfg = {"data_sources": [
        {"source_name": "A", "path": a, "transformations": [
            {"column_name": "source_key", "expression": "'A'"}]},
        {"source_name": "B", "path": b, "transformations": [
            {"column_name": "id", "expression": "ID"}, {"column_name": "v", "expression": "value"},
            {"column_name": "source_key", "expression": "'B'"}]}],
        "columns": [{"col_name": "id", "col_type": "int"}, {"col_name": "v", "col_type": "int"},
                    {"col_name": "source_key", "col_type": "string"}],
        "keys": ["source_key", "id"],
        "measures": [{"name": "n", "func": "count_star"}, {"name": "total", "func": "sum", "column": "v"}],
        "output_path": str(tmp_path / "out")}
    spec = load_mapping(spark, write_text_file("mapping.json", json.dumps(cfg)))
    run_mapping(spark, spec)
    back = spark.read.csv(str(tmp_path / "out"), header=True, inferSchema=True)
    got = sorted((r.source_key, r.id, r.n, r.total) for r in back.collect())
    assert got == [("A", 1, 2, 15), ("A", 2, 1, 7), ("B", 2, 1, 1)]


def test_services_from_config_file(spark, write_text_file, tmp_path):
    events = "/root/testdata/sf0.001/events.parquet"

    @service("test.DailyEvents")
    def _daily(base):
        return JobSpec("daily", SourceSpec("events", events, "parquet"), LoadSpec.from_dict({
            "targetTable": f"{base}/daily", "load_type": "incremental",
            "incremental_column": "load_date", "slice_mode": "slice",
            "transformations": [{"column_name": "load_date", "expression": "cast(ts as date)"}]}))

    path = write_text_file("services.json", json.dumps({"services": ["test.DailyEvents"]}))
    day = dt.date(2024, 1, 3)
    run_services(spark, path, day, base=str(tmp_path))
    got = spark.read.parquet(str(tmp_path / "daily"))
    want = spark.read.parquet(events).filter(F.col("ts").cast("date") == F.lit(day)).count()
    assert got.count() == want > 0


def test_mapping_summary_appended_partitioned_by_source(spark, write_text_file, tmp_path):
    a = write_text_file("a2.csv", "id,v\n1,10\n2,5\n")
    cfg = {"data_sources": [{"source_name": "A", "path": a, "transformations": [
        {"column_name": "source_key", "expression": "'A'"}]}],
        "output_path": str(tmp_path / "parts")}
    spec = load_mapping(spark, write_text_file("m2.json", json.dumps(cfg)))
    for _ in range(2):
        run_mapping(spark, spec, keys=["source_key", "id"], measures=[{"name": "n", "func": "count_star"}],
                    output_format="parquet", partition_by=["source_key"], mode="append")
    assert (tmp_path / "parts" / "source_key=A").is_dir()
    assert spark.read.parquet(str(tmp_path / "parts")).count() == 4  # appended twice
