"""Rerun tests for full and incremental loads and the job runner (LOD-1..7)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conformkit.plans import load as L
from conformkit.plans.jobs import JobSpec, plan_job, resolve_services, run_jobs, service
from conformkit.specs import LoadSpec, LoadType, SourceSpec, SpecError, Transform

DAY = dt.date(2024, 1, 15)
EVENTS = "/root/testdata/sf0.01/events.parquet"


@pytest.fixture
def events(spark):
    return spark.read.parquet(EVENTS).withColumn("load_date", F.col("ts").cast("date"))


def _counts(spark, path):
    df = spark.read.schema("event_id BIGINT, value DOUBLE, load_date DATE").parquet(path)
    return {r.load_date: (r.n, r.v) for r in
            df.groupBy("load_date").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v")).collect()}


def test_incremental_replace_is_idempotent_and_local(spark, events, tmp_path):
    target = str(tmp_path / "daily")
    L.full_load_files(events, target, partition_by=("load_date",))
    before = _counts(spark, target)
    new = events.filter(F.col("load_date") == F.lit(DAY)).limit(7).drop("load_date")
    L.incremental_replace_files(spark, new, target, "load_date", DAY)
    once = _counts(spark, target)
    L.incremental_replace_files(spark, new, target, "load_date", DAY)
    twice = _counts(spark, target)
    assert once == twice
    assert once[DAY][0] == 7
    assert {d: c for d, c in once.items() if d != DAY} == {d: c for d, c in before.items() if d != DAY}


def test_empty_new_slice_empties_the_day(spark, events, tmp_path):
    target = str(tmp_path / "daily")
    L.full_load_files(events, target, partition_by=("load_date",))
    n_before = spark.read.parquet(target).count()
    day_rows = events.filter(F.col("load_date") == F.lit(DAY)).count()
    res = L.incremental_replace_files(spark, events.limit(0), target, "load_date", DAY)
    assert res.rows_in_slice == 0
    after = _counts(spark, target)
    assert DAY not in after
    assert sum(n for n, _ in after.values()) == n_before - day_rows


def test_stamp_uses_the_run_date(spark):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 1)), (2, None)], "id int, load_date date")
    assert {r.load_date for r in L.stamp(df, "load_date", DAY).collect()} == {DAY}
    assert L.stamp(spark.range(1), "load_date", DAY).schema["load_date"].dataType.simpleString() == "date"


def test_kept_rows_keep_null_dates(spark):
    df = spark.createDataFrame([(1, DAY), (2, None), (3, dt.date(2024, 1, 1))], "id int, d date")
    assert sorted(r.id for r in L.kept_rows(df, "d", DAY).collect()) == [2, 3]


def test_full_load_rerun_replaces(spark, tmp_path):
    target = str(tmp_path / "copy")
    df = spark.range(10)
    L.full_load_files(df, target)
    L.full_load_files(df, target)
    assert spark.read.parquet(target).count() == 10
    assert sorted(p.name for p in tmp_path.iterdir()) == ["copy"]  # no staging left behind


def test_failed_full_load_keeps_the_old_target(spark, tmp_path):
    target = str(tmp_path / "copy")
    L.full_load_files(spark.range(10), target)
    failing = spark.range(5).select(F.assert_true(F.col("id") < 3).alias("x"), "id")
    with pytest.raises(Exception):
        L.full_load_files(failing, target)
    assert spark.read.parquet(target).count() == 10
    assert sorted(p.name for p in tmp_path.iterdir()) == ["copy"]


def test_full_load_may_read_its_own_target(spark, tmp_path):
    # Staging makes a rewrite of a table from itself safe (the old files stay
    # readable until the new ones are committed).
    target = str(tmp_path / "copy")
    L.full_load_files(spark.range(10), target)
    L.full_load_files(spark.read.parquet(target).filter("id % 2 = 0"), target)
    assert spark.read.parquet(target).count() == 5


def test_unknown_load_type_is_refused():
    with pytest.raises(SpecError):
        LoadType.parse("incremntal")
    with pytest.raises(SpecError):
        LoadSpec("t", LoadType.INCREMENTAL)  # no incremental column


def test_source_equal_to_target_is_refused(spark, tmp_path):
    path = str(tmp_path / "same")
    spark.range(3).write.parquet(path)
    job = JobSpec("loop", SourceSpec("s", path, "parquet"), LoadSpec(path))
    with pytest.raises(SpecError, match="same"):
        plan_job(spark, job, DAY)


def test_jobs_are_all_planned_before_any_write(spark, tmp_path):
    good = JobSpec("good", SourceSpec("ev", EVENTS, "parquet"), LoadSpec(str(tmp_path / "good")))
    bad = JobSpec("bad", SourceSpec("ev", EVENTS, "parquet"),
                  LoadSpec(str(tmp_path / "bad"),
                           transformations=(Transform("x", "no_such_column + 1"),)))
    with pytest.raises(SpecError):
        run_jobs(spark, [good, bad], DAY)
    assert not (tmp_path / "good").exists()


def test_two_jobs_on_one_target_are_refused(spark, tmp_path):
    spec = LoadSpec(str(tmp_path / "t"))
    jobs = [JobSpec("a", SourceSpec("ev", EVENTS, "parquet"), spec),
            JobSpec("b", SourceSpec("ev", EVENTS, "parquet"), spec)]
    with pytest.raises(SpecError, match="same target"):
        run_jobs(spark, jobs, DAY)


def test_slice_mode_reads_only_the_business_day(spark, tmp_path):
    spec = LoadSpec.from_dict({
        "targetTable": str(tmp_path / "daily"), "load_type": "incremental",
        "incremental_column": "load_date", "slice_mode": "slice",
        "transformations": [{"column_name": "load_date", "expression": "cast(ts as date)"}]})
    run_jobs(spark, [JobSpec("ev", SourceSpec("ev", EVENTS, "parquet"), spec)], DAY)
    got = spark.read.parquet(str(tmp_path / "daily"))
    expected = spark.read.parquet(EVENTS).filter(F.col("ts").cast("date") == F.lit(DAY)).count()
    assert got.count() == expected
    assert {r.load_date for r in got.select("load_date").distinct().collect()} == {DAY}


def test_services_resolve_from_the_registry_only(tmp_path):
    @service("test.CopyEvents")
    def _copy(target):
        return JobSpec("copy", SourceSpec("ev", EVENTS, "parquet"), LoadSpec(target))

    jobs = resolve_services({"services": ["test.CopyEvents"]}, target=str(tmp_path / "x"))
    assert [j.name for j in jobs] == ["copy"]
    with pytest.raises(SpecError, match="unknown services"):
        resolve_services({"services": ["os.system"]})


def test_jdbc_job_reading_its_own_target_is_refused():
    from conformkit.specs import ConnectionProfile
    url = "jdbc:none://db/x"
    src = SourceSpec("holdings", "SELECT mis_date, qty FROM public.CARGO_DAYS", "jdbc",
                     options={"url": url})
    tgt = LoadSpec("CARGO_DAYS", LoadType.INCREMENTAL, "mis_date", format="jdbc")
    job = JobSpec("loop", src, tgt, profile=ConnectionProfile(url=url))
    with pytest.raises(SpecError, match="same"):
        plan_job(None, job, DAY)
    other = JobSpec("ok", SourceSpec("h", "SELECT * FROM CARGO_DAYS_SRC", "jdbc",
                                     options={"url": url}), tgt, profile=ConnectionProfile(url=url))
    from conformkit.plans.jobs import _reads_target
    assert not _reads_target(other)


def test_failed_incremental_replace_keeps_the_old_slice(spark, events, tmp_path):
    # D6: the new slice is committed with the job; a job that fails midway
    # leaves the old day untouched.
    target = str(tmp_path / "daily")
    L.full_load_files(events, target, partition_by=("load_date",))
    before = _counts(spark, target)
    failing = (events.filter(F.col("load_date") == F.lit(DAY)).drop("load_date")
               .withColumn("value", F.assert_true(F.col("event_id") < 0).cast("double")))
    with pytest.raises(Exception):
        L.incremental_replace_files(spark, failing, target, "load_date", DAY)
    assert _counts(spark, target) == before


def test_rows_with_a_null_load_date_survive_a_replace(spark, tmp_path):
    target = str(tmp_path / "daily")
    rows = spark.createDataFrame([(1, DAY), (2, None), (3, dt.date(2024, 1, 1))],
                                 "id int, load_date date")
    L.full_load_files(rows, target, partition_by=("load_date",))
    L.incremental_replace_files(spark, spark.createDataFrame([(9,)], "id int"), target, "load_date", DAY)
    got = sorted((r.id, r.load_date) for r in spark.read.parquet(target).collect())
    assert got == [(2, None), (3, dt.date(2024, 1, 1)), (9, DAY)]


def test_jobs_align_to_an_existing_target_and_report_rejects(spark, tmp_path):
    target = str(tmp_path / "t")
    spark.createDataFrame([(1, 1.5)], "ID int, AMOUNT double").write.parquet(target)
    src = str(tmp_path / "src.csv")
    with open(src, "w") as f:
        f.write("id,amount,extra\n2,2.5,x\n3,oops,y\n")
    job = JobSpec("j", SourceSpec("s", src, "csv"), LoadSpec(target), align_to_target=True,
                  safe_cast=True, reject_path=str(tmp_path / "rejects"))
    run_jobs(spark, [job], DAY)
    got = spark.read.parquet(target)
    assert got.columns == ["ID", "AMOUNT"]
    assert sorted(tuple(r) for r in got.collect()) == [(2, 2.5), (3, None)]
    rej = spark.read.parquet(str(tmp_path / "rejects")).collect()
    assert [(r.id, r.amount, r.rejected_columns, r.run_date) for r in rej] == [("3", "oops", ["AMOUNT"], DAY)]


def test_first_load_has_no_target_to_align_to(spark, tmp_path):
    job = JobSpec("j", SourceSpec("s", EVENTS, "parquet"), LoadSpec(str(tmp_path / "new")),
                  align_to_target=True)
    run_jobs(spark, [job], DAY)
    assert spark.read.parquet(str(tmp_path / "new")).count() == spark.read.parquet(EVENTS).count()
