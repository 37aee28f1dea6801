"""Runs that break off and go on: ledger, rejects, catalog tables, batches, scratch."""

from __future__ import annotations

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conformkit import session
from conformkit.plans import ledger as LG
from conformkit.plans.jobs import JobSpec, run_jobs
from conformkit.plans.load import load
from conformkit.sinks import files as SNK
from conformkit.specs import LoadSpec, LoadType, SourceSpec, SpecError

DAY = dt.date(2024, 1, 15)


def job(tmp_path, name, runs, broken=False, value=1):
    def source(spark, day):
        runs.append(name)
        fault = F.raise_error(F.lit("lost")).cast("int") if broken else F.lit(value)
        return spark.range(5).select("id", fault.alias("v"))
    return JobSpec(name, source, LoadSpec(str(tmp_path / name)))


def written_at(tmp_path, name):
    return {os.path.basename(f): os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp_path}/{name}/part-*")}


def test_a_rerun_goes_on_behind_the_last_finished_job(spark, tmp_path):
    ledger, runs = str(tmp_path / "ledger"), []
    with pytest.raises(Exception, match="lost"):
        run_jobs(spark, [job(tmp_path, "a", runs), job(tmp_path, "b/2", runs, broken=True), job(tmp_path, "c", runs)], DAY, ledger)
    first = written_at(tmp_path, "a")
    assert first and not os.path.exists(tmp_path / "c")
    assert [r.job for r in LG.entries(spark, ledger).collect()] == ["a"]
    jobs = [job(tmp_path, "a", runs), job(tmp_path, "b/2", runs), job(tmp_path, "c", runs)]
    results = run_jobs(spark, jobs, DAY, ledger)
    assert [r.skipped for r in results] == [True, False, False]
    assert written_at(tmp_path, "a") == first  # written once
    assert {r.job for r in LG.entries(spark, ledger).collect()} == {"a", "b/2", "c"}
    before = {n: written_at(tmp_path, n) for n in ("a", "b/2", "c")}
    assert all(r.skipped for r in run_jobs(spark, jobs, DAY, ledger))
    assert before == {n: written_at(tmp_path, n) for n in before}
    # Another date, a changed job, and force are written.
    assert not any(r.skipped for r in run_jobs(spark, jobs, dt.date(2024, 1, 16), ledger))
    changed = run_jobs(spark, [job(tmp_path, "a", runs, value=2), *jobs[1:]], DAY, ledger)
    assert [r.skipped for r in changed] == [False, True, True]
    assert not any(r.skipped for r in run_jobs(spark, jobs, DAY, ledger, force=True))


def test_a_changed_source_path_is_another_job(spark, tmp_path):
    for name in ("x", "y"):
        spark.range(3).write.parquet(str(tmp_path / name))
    of = lambda p: JobSpec("j", SourceSpec("s", str(tmp_path / p), "parquet"), LoadSpec(str(tmp_path / "out")))
    ledger = str(tmp_path / "ledger")
    assert [run_jobs(spark, [of(p)], DAY, ledger)[0].skipped for p in ("x", "x", "y")] == [False, True, False]


def test_a_ledger_needs_one_name_per_job(spark, tmp_path):
    twice = [JobSpec("a", lambda s, d: s.range(1), LoadSpec(str(tmp_path / n))) for n in "xy"]
    with pytest.raises(SpecError, match="one name"):
        run_jobs(spark, twice, DAY, str(tmp_path / "ledger"))
    assert LG.entries(spark, str(tmp_path / "ledger")).count() == 0


def rejecting(tmp_path, name, rows):
    return JobSpec(name, lambda s, d: s.createDataFrame(rows, "n string"), LoadSpec(str(tmp_path / f"out-{name}")),
                   target_schema=T.StructType([T.StructField("n", T.IntegerType())]), safe_cast=True,
                   reject_path=str(tmp_path / "rejects"))


def test_two_jobs_share_a_reject_folder(spark, tmp_path):
    jobs = [rejecting(tmp_path, "one", [("1",), ("oops",)]), rejecting(tmp_path, "two/b", [("bad",), ("worse",)])]
    for _ in range(2):
        run_jobs(spark, jobs, DAY)
    rows = spark.read.parquet(str(tmp_path / "rejects")).collect()
    assert sorted((r.job, r.n) for r in rows) == [("one", "oops"), ("two/b", "bad"), ("two/b", "worse")]


def test_an_older_reject_layout_is_refused_before_any_write(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "rejects" / "run_date=2024-01-01"))
    with pytest.raises(SpecError, match="not partitioned"):
        run_jobs(spark, [rejecting(tmp_path, "one", [("oops",)])], DAY)
    assert not os.path.exists(tmp_path / "out-one")


def test_full_load_without_a_date_to_stamp_is_refused(spark, tmp_path):
    spec = LoadSpec(str(tmp_path / "t"), incremental_column="load_date")
    with pytest.raises(SpecError, match="needs a run_date"):
        load(spark, spark.range(2), spec, None)
    load(spark, spark.range(2), spec, DAY)
    assert {r.load_date for r in spark.read.parquet(spec.target).collect()} == {DAY}


def test_catalog_table_full_and_incremental(spark):
    name = session.scratch_table(spark, "t")
    full = LoadSpec(name, incremental_column="load_date", format="table")
    step = LoadSpec(name, LoadType.INCREMENTAL, "load_date", format="table")
    df = spark.createDataFrame([(1, "a", DAY), (2, "b", dt.date(2024, 1, 1)), (3, "c", None)], "id int, t string, load_date date")
    rows = lambda: sorted((r.id, r.t, r.load_date) for r in spark.table(name).collect())
    try:
        with pytest.raises(SpecError, match="does not exist"):
            load(spark, df, step, DAY)
        load(spark, df, full, None)
        load(spark, df, full, None)  # a rerun replaces
        assert rows() == [(1, "a", DAY), (2, "b", dt.date(2024, 1, 1)), (3, "c", None)]
        new = spark.createDataFrame([("9", "z")], "ID string, extra string")
        for _ in range(2):
            assert load(spark, new, step, DAY).rows_in_slice == 1
        assert rows() == [(2, "b", dt.date(2024, 1, 1)), (3, "c", None), (9, None, DAY)]
        assert load(spark, new.limit(0), step, DAY).rows_in_slice == 0  # an empty day empties its partition
        assert rows() == [(2, "b", dt.date(2024, 1, 1)), (3, "c", None)]
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        load(spark, df.where("id = 1"), full, None)
        assert rows() == [(1, "a", DAY)]  # all partitions are replaced
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic"
        with pytest.raises(SpecError, match="partitioned"):
            load(spark, df, LoadSpec(name, format="table"), None)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_batch_is_replaced_in_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda: sorted((r.id, r.k, str(r.batch_id)) for r in spark.read.parquet(path).collect())
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    for _ in range(2):
        SNK.append_batch(df, path, "b 1/x", ["k"])
    SNK.append_batch(df.where("id = 2"), path, "b2", ["k"])
    assert [r[0] for r in rows()] == [1, 2, 2, 3]
    SNK.append_batch(df.where("id = 1"), path, "b 1/x", ["k"])  # fewer partitions than before
    assert rows() == [(1, "a", "b 1/x"), (2, "b", "b2")]
    with pytest.raises(Exception):
        SNK.append_batch(df.select(F.raise_error(F.lit("lost")).cast("int").alias("id"), "k"), path, "b2", ["k"])
    assert rows() == [(1, "a", "b 1/x"), (2, "b", "b2")]  # a failed run leaves the batch as it was
    SNK.append_batch(df.limit(0), path, "b2", ["k"])
    assert rows() == [(1, "a", "b 1/x")]
    assert not glob.glob(f"{path}/_staging*")
    with pytest.raises(SpecError):
        SNK.append_batch(df.withColumn("BATCH_ID", F.lit(1)), path, "b3")


def test_scratch_is_cleaned_on_demand(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "checkpoint_root", lambda s: str(tmp_path / "shared"))
    spark.range(2).write.parquet(session.scratch_path(spark, "left-behind"))
    name = session.scratch_table(spark, "left")
    spark.range(2).write.saveAsTable(name)
    (tmp_path / "shared" / "other").mkdir()
    found = session.clean_scratch(spark)
    assert name in found and any("left-behind" in f for f in found)
    assert os.listdir(tmp_path / "shared") == ["other"] and not spark.catalog.tableExists(name)
    assert session.clean_scratch(spark) == []
