"""Configured load jobs: registry, planning and the runner (LOD-4..7).

The reference imports a class per service from a dotted path written in its
config.  Here services are registered explicitly in code (``@service``), and a
config only names them, so no text from a config file is ever imported or
executed (LOD-5).

``run_jobs`` plans every job first (all frames are lazy; no data moves), checks
them, then writes them in order (LOD-4), keeping a ledger if asked to.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conformkit.operators.conform import align_to_target, apply_transformations, cast_rejects
from conformkit.plans.ledger import commit, fingerprint, finished
from conformkit.plans.load import LoadResult, check_layout, incremental_replace_files, load
from conformkit.specs import ConnectionProfile, LoadSpec, SliceMode, SourceSpec, SpecError
from conformkit.functions.dates import business_date
from conformkit.session import path_exists
from conformkit.sources.jdbc import table_schema
from conformkit.sources.files import read_config, read_source


@dataclass(frozen=True)
class JobSpec:
    """One service: where rows come from, how they are shaped, where they go.

    ``source`` is a ``SourceSpec`` or a callable ``(spark, run_date) -> DataFrame``
    (the reference's ``get_sql_query``).  Rows are aligned (PRJ-4) to
    ``target_schema`` when given, or, with ``align_to_target``, to the schema
    probed from the existing target (SRC-10: no rows are read; a first load
    has nothing to probe and is written as shaped).  ``safe_cast`` turns
    values that do not fit the target type into nulls instead of failing the
    job, and ``reject_path`` then receives those source rows with the names of
    the failing columns, as Parquet partitioned by job name and run date (several
    jobs may share it; a rerun replaces its own rejects).
    """

    name: str
    source: SourceSpec | Callable[[SparkSession, dt.date], DataFrame]
    load: LoadSpec
    target_schema: T.StructType | None = None
    profile: ConnectionProfile | None = None
    source_id: str | None = None
    options: Mapping[str, object] = field(default_factory=dict)
    align_to_target: bool = False
    safe_cast: bool = False
    reject_path: str | None = None


@dataclass(frozen=True)
class PlannedJob:
    job: JobSpec
    frame: DataFrame
    rejects: DataFrame | None = None


def probe_target_schema(spark: SparkSession, job: JobSpec) -> T.StructType | None:
    """The existing target's schema, without reading its rows (SRC-10)."""
    spec = job.load
    if spec.format == "jdbc":
        if job.profile is None:
            raise SpecError(f"job {job.name!r}: a jdbc target needs a connection profile")
        return table_schema(spark, job.profile, spec.target)
    if spec.format == "table":
        return spark.table(spec.target).schema if spark.catalog.tableExists(spec.target) else None
    if not path_exists(spark, spec.target):
        return None
    reader = spark.read.format(spec.format)
    if spec.format == "csv":
        reader = reader.option("header", True).option("inferSchema", True)
    return reader.load(spec.target).schema


_REGISTRY: dict[str, Callable[..., JobSpec]] = {}


def service(name: str):
    """Register a job factory under ``name`` (what a services config lists)."""
    def deco(factory: Callable[..., JobSpec]):
        if name in _REGISTRY:
            raise SpecError(f"service {name!r} registered twice")
        _REGISTRY[name] = factory
        return factory
    return deco


def resolve_services(config: Mapping[str, Sequence[str]], **factory_args) -> list[JobSpec]:
    """``{"services": [name, ...]}`` → job specs, by registry lookup only."""
    names = list(config.get("services", ()))
    missing = [n for n in names if n not in _REGISTRY]
    if missing:
        raise SpecError(f"unknown services {missing}; registered: {sorted(_REGISTRY)}")
    return [_REGISTRY[n](**factory_args) for n in names]


def _source_frame(spark: SparkSession, job: JobSpec, run_date: dt.date) -> DataFrame:
    if isinstance(job.source, SourceSpec):
        return read_source(spark, job.source)
    return job.source(spark, run_date)


def _source_identity(job: JobSpec) -> str | None:
    if job.source_id:
        return job.source_id
    if isinstance(job.source, SourceSpec):
        return job.source.path
    return None


def _same_location(a: str | None, b: str | None) -> bool:
    if not a or not b:
        return False
    one, two = ("/" + p.removeprefix("file:").strip("/") + "/" for p in (a, b))
    return one.startswith(two) or two.startswith(one)  # the same folder or one inside the other


def _reads_target(job: JobSpec) -> bool:
    """D16: does the job read the relation it writes?  Files: same path, or one
    inside the other.  JDBC:
    same URL and the target table named in the source SQL."""
    if _same_location(_source_identity(job), job.load.target):
        return True
    src = job.source
    if (isinstance(src, SourceSpec) and src.format == "jdbc" and job.load.format == "jdbc"
            and job.profile is not None and src.options.get("url") == job.profile.url):
        table = re.escape(job.load.target.split(".")[-1])
        return re.search(rf"(?<![\w$]){table}(?![\w$])", src.path or "", re.I) is not None
    return False


def plan_job(spark: SparkSession, job: JobSpec, run_date: dt.date) -> PlannedJob:
    """Source → transformations → (slice filter) → alignment, all lazy."""
    if _reads_target(job):
        # D16: reading a relation lazily while overwriting it loses the rows.
        raise SpecError(f"job {job.name!r}: source and target are the same ({job.load.target})")
    df = _source_frame(spark, job, run_date)
    spec = job.load
    df = apply_transformations(df, spec.transformations, job.name)
    if spec.slice_mode is SliceMode.SLICE and spec.incremental_column:
        # FLT-3: only the business date's rows.  Written on the transformed
        # column; Catalyst moves the filter below the projection into the scan.
        df = df.filter(F.col(spec.incremental_column).cast("date") == F.lit(run_date))
    schema = job.target_schema
    if schema is None and job.align_to_target:
        schema = probe_target_schema(spark, job)
    rejects = None
    if schema is not None:
        if job.reject_path:
            if not job.safe_cast:
                raise SpecError(f"job {job.name!r}: reject_path needs safe_cast")
            rejects = cast_rejects(df, schema).withColumn("run_date", F.lit(run_date))
        df = align_to_target(df, schema, safe_cast=job.safe_cast)
    return PlannedJob(job, df, rejects)


def _reject_folder(job: JobSpec) -> str:
    return f"{job.reject_path.rstrip('/')}/job={quote(job.name, safe='')}"


def run_jobs(spark: SparkSession, jobs: Iterable[JobSpec],
             run_date: dt.date | str | None = None, ledger: str | None = None,
             force: bool = False) -> list[LoadResult]:
    """Plan all jobs, then write each (LOD-4, LOD-6).

    Planning first means a broken expression or missing column in the last job
    fails before the first job has written anything.  With ``ledger`` (a folder in
    shared storage) every job that has been written leaves a marker for the run
    date, and a rerun after a failure goes on with those that have none
    (``plans.ledger``); ``force`` writes all of them again.
    """
    day = business_date(run_date)
    jobs = list(jobs)
    names = [j.name for j in jobs]
    if ledger and len(set(names)) != len(names):
        raise SpecError(f"a ledger needs one name per job: {names}")
    planned = [plan_job(spark, j, day) for j in jobs]
    targets = [p.job.load.target for p in planned]
    if len(set(targets)) != len(targets):
        raise SpecError(f"two jobs write the same target: {targets}")
    folders = [_reject_folder(p.job) for p in planned if p.rejects is not None]
    if len(set(folders)) != len(folders):
        raise SpecError(f"two jobs of one name write the same rejects: {folders}")
    for p in planned:
        if p.rejects is not None:  # an older layout is refused before anything is written
            check_layout(spark, p.job.reject_path, "job")
            check_layout(spark, _reject_folder(p.job), "run_date")
    results = []
    for p in planned:
        mark = fingerprint(p.job, p.frame) if ledger else None
        done = finished(spark, ledger, p.job.name, day, mark) if ledger and not force else None
        if done is not None:
            results.append(done)
            continue
        result = load(spark, p.frame, p.job.load, day, p.job.profile)
        if p.rejects is not None:
            # One folder per run date, replaced: a rerun does not add rejects twice.
            incremental_replace_files(spark, p.rejects, _reject_folder(p.job), "run_date", day)
        if ledger:
            commit(spark, ledger, p.job.name, day, mark, result)
        results.append(result)
    return results


def run_services(spark: SparkSession, services_config: Mapping[str, Sequence[str]] | str,
                 run_date: dt.date | str | None = None, ledger: str | None = None,
                 force: bool = False, **factory_args) -> list[LoadResult]:
    """The migration flow (LOD-4..7): the services a config names, looked up in
    the registry, planned together and then written.  ``services_config`` is
    the dict or the path of its JSON file; ``factory_args`` (connection
    profiles, config folders, …) are passed to every service factory.  A config may
    name its ``ledger`` folder itself."""
    if isinstance(services_config, str):
        services_config = read_config(spark, services_config)
    return run_jobs(spark, resolve_services(services_config, **factory_args), run_date,
                    ledger or services_config.get("ledger"), force)
