"""Run ledger: what a run of several jobs has finished (LOD-4, LOD-6).

A ledger is a folder in shared storage with one small JSON marker per (run date,
job).  A marker is written after the job's rows (and rejects) have been committed,
under another name that is then renamed, so it is there in full or not at all.  A
job whose run was lost between its commit and its marker is written again, which
loads allow: each replaces its target or its slice.

A marker holds a fingerprint of the job: its load, its alignment and the plan and
schema of its rows.  A job that has been changed since is written again.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import re
import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession

from conformkit.plans.load import LoadResult
from conformkit.session import hadoop_path, path_exists, read_small_text, write_small_text


def marker_path(ledger: str, job: str, day: dt.date) -> str:
    return f"{ledger.rstrip('/')}/run_date={day.isoformat()}/{quote(job, safe='')}.json"


def fingerprint(job, frame: DataFrame) -> str:
    """A hash of what a job would write: its source, load spec and target schema, and
    the analysed plan of its rows without Spark's column numbers."""
    plan = frame._jdf.queryExecution().analyzed().toString()
    plan = re.sub(r"#\d+L?|lambda \w+|_\d+|plan_id=\d+", "", plan)
    source = None if callable(job.source) else job.source
    parts = (source, job.load, job.target_schema, job.align_to_target, job.safe_cast, frame.schema.simpleString(), plan)
    return hashlib.sha256("\n".join(map(str, parts)).encode()).hexdigest()


def finished(spark: SparkSession, ledger: str, job: str, day: dt.date, mark: str) -> LoadResult | None:
    """The result of a job whose marker for the run date has this fingerprint."""
    path = marker_path(ledger, job, day)
    if not path_exists(spark, path):
        return None
    held = json.loads(read_small_text(spark, path))
    if held["fingerprint"] != mark:
        return None
    return LoadResult(held["target"], held["load_type"], day, held["rows_in_slice"], skipped=True)


def commit(spark: SparkSession, ledger: str, job: str, day: dt.date, mark: str, result: LoadResult) -> None:
    """Write the marker of a job that has been written."""
    path = marker_path(ledger, job, day)
    folder, name = path.rsplit("/", 1)
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    write_small_text(spark, draft, json.dumps({
        "job": job, "run_date": day.isoformat(), "fingerprint": mark, "target": result.target,
        "load_type": result.load_type, "rows_in_slice": result.rows_in_slice,
        "finished_at": dt.datetime.now(dt.timezone.utc).isoformat(timespec="seconds")}))
    fs, to = hadoop_path(spark, path)
    if fs.exists(to):
        fs.delete(to, False)
    if not fs.rename(hadoop_path(spark, draft)[1], to):
        raise OSError(f"cannot write marker {path}")


def entries(spark: SparkSession, ledger: str) -> DataFrame:
    """job, run_date, target, load_type, rows_in_slice, finished_at of every marker."""
    schema = "job string, run_date date, target string, load_type string, rows_in_slice long, finished_at string"
    if not path_exists(spark, ledger):
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema).option("multiLine", True)
            .option("pathGlobFilter", "*.json").json(ledger).select(*[c.split()[0] for c in schema.split(", ")]))
