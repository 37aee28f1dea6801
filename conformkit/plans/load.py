"""Full and incremental loads that can be rerun safely (LOD-1..3, SNK-5, FLT-2).

Tables of the session catalog (format ``table``)
    * full load: ``INSERT OVERWRITE`` of an existing table, whose columns, types and
      partitioning stay and decide; a table that does not exist is created,
      partitioned by the incremental column.
    * incremental: ``INSERT OVERWRITE`` of one static partition: exactly that day,
      also when its new slice is empty.

Files (Parquet/CSV/JSON folders)
    * full load: write to a sibling staging folder, then swap it in by renames
      after the job commits, so a failed job leaves the old target intact.
    * incremental: the target is partitioned by the incremental column; the new
      slice replaces exactly its partition with dynamic partition overwrite,
      which commits the new files and swaps the partition in one job commit, so
      a failed job leaves the old slice in place (D6).  An EMPTY new slice
      writes no partition, so dynamic overwrite would keep the old day; that
      case removes the partition explicitly.

JDBC
    * full load: overwrite with ``truncate=true`` (D15: keep the table and its
      grants instead of drop + create).
    * incremental: executors write the slice to a staging table, then the driver
      runs ONE transaction: delete the slice from the target, insert it from
      staging.  A failure rolls back, so the target never loses the slice.

One ``run_date`` both stamps/selects the new slice and names the slice that is
replaced (D5).
"""

from __future__ import annotations

import contextlib
import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conformkit.operators.conform import align_to_target
from conformkit.session import delete_path, hadoop_path, swap_in
from conformkit.sinks.jdbc import write_jdbc
from conformkit.sources.jdbc import table_schema
from conformkit.specs import ConnectionProfile, LoadSpec, LoadType, SpecError, check_identifier


@dataclass(frozen=True)
class LoadResult:
    target: str
    load_type: str
    run_date: dt.date | None
    rows_in_slice: int | None
    skipped: bool = False  # a ledger says that it was written before


def _partition_value(v: dt.date | str) -> str:
    return v.isoformat() if isinstance(v, dt.date) else str(v)


def stamp(df: DataFrame, column: str, run_date: dt.date | str) -> DataFrame:
    """Set the incremental column of every row to the business date (snapshot
    mode, D7), keeping the column's type when it already exists."""
    existing = [f for f in df.schema.fields if f.name.lower() == column.lower()]
    typ = existing[0].dataType if existing else T.DateType()
    value = F.lit(_partition_value(run_date)).cast(T.DateType())
    if not isinstance(typ, T.DateType):
        value = value.cast(typ)
    return df.withColumn(existing[0].name if existing else column, value)


def kept_rows(df: DataFrame, column: str, run_date: dt.date | str) -> DataFrame:
    """Rows a slice delete keeps (FLT-2).  Null-safe: rows whose date is null are
    kept, where ``col <> d`` would silently drop them too."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(_partition_value(run_date)).cast("date")))


# --------------------------------------------------------------------------- files


def full_load_files(df: DataFrame, target: str, fmt: str = "parquet",
                    partition_by: tuple[str, ...] = (), staged: bool = True) -> None:
    """Replace a file target with ``df`` (LOD-1).

    A plain overwrite deletes the target before the job runs, so a failed job
    would leave it empty.  With ``staged`` (default) the rows are written to a
    sibling folder first and swapped in by two renames only after the job has
    committed; a failure leaves the old target as it was.  (Renames are atomic
    on HDFS-like file systems; on object stores use a table format for
    atomic replacement.)
    """
    w = df
    if partition_by:
        # REBALANCE lets AQE split a hot partition value across tasks and merge
        # small ones, instead of one task per value.
        w = df.hint("rebalance", *partition_by)
    out = f"{target.rstrip('/')}.__staging-{uuid.uuid4().hex}" if staged else target
    writer = w.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    try:
        writer.save(out)
    except Exception:
        if staged:
            delete_path(df.sparkSession, out)
        raise
    if staged:
        target = target.rstrip("/")
        swap_in(df.sparkSession, out, target, f"{target}.__old-{uuid.uuid4().hex}")


def check_layout(spark: SparkSession, target: str, column: str) -> None:
    """Refuse a target whose files are not partitioned by ``column``: a slice next
    to files at the root would hide their rows from readers."""
    fs, root = hadoop_path(spark, target)
    if not fs.exists(root):
        return
    for entry in fs.listStatus(root):
        name = entry.getPath().getName()
        if not name.startswith(("_", ".")) and not (
                entry.isDirectory() and name.lower().startswith(f"{column.lower()}=")):
            raise SpecError(f"{target} is not partitioned by {column!r} ({name}); load it in full first")


def incremental_replace_files(spark: SparkSession, df: DataFrame, target: str, column: str,
                              run_date: dt.date | str, fmt: str = "parquet") -> LoadResult:
    """Replace the ``column = run_date`` slice of a file target with ``df``
    (LOD-2).  ``df`` is stamped with ``run_date`` first, so the slice written and
    the slice replaced cannot disagree.  Running it twice gives the same target
    as running it once; other slices are untouched.
    """
    check_layout(spark, target, column)
    new = stamp(df, column, run_date)
    name = [f.name for f in new.schema.fields if f.name.lower() == column.lower()][0]
    seen = Observation()  # counted by the write itself: the source runs once
    writer = (new.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").format(fmt)
              .option("partitionOverwriteMode", "dynamic").partitionBy(name))
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(target)
    rows = int(seen.get.get("n") or 0)
    if rows == 0:
        # Dynamic overwrite only touches partitions it writes; an empty slice
        # writes none, so remove the day explicitly (delete-then-append would
        # leave it empty too).
        delete_path(spark, f"{target.rstrip('/')}/{name}={_partition_value(run_date)}")
    return LoadResult(target, "incremental", run_date, rows)


# --------------------------------------------------------------------------- tables


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def full_load_table(df: DataFrame, table: str, partition_by: tuple[str, ...] = (), fmt: str = "parquet",
                    safe_cast: bool = False) -> None:
    """Replace the rows of a catalog table (LOD-1), in one statement.  An existing
    table keeps its definition: rows are aligned to it by name, and partitions that
    the new rows lack go too.  Otherwise it is created with the rows' columns."""
    spark = df.sparkSession
    check_identifier(table, "table")
    if not spark.catalog.tableExists(table):
        writer = (df.hint("rebalance", *partition_by) if partition_by else df).write.format(fmt)
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)
        return
    held = [c.lower() for c in _partition_columns(spark, table)]
    if held != [c.lower() for c in partition_by]:
        raise SpecError(f"table {table} is partitioned by {held}, not by {list(partition_by)}")
    rows = align_to_target(df, spark.table(table).schema, safe_cast)
    rows = rows.hint("rebalance", *held) if held else rows
    with _static_overwrite(spark):
        spark.sql(f"INSERT OVERWRITE TABLE {table} SELECT * FROM {{rows}}", rows=rows)


@contextlib.contextmanager
def _static_overwrite(spark: SparkSession):
    """An overwrite of a whole table replaces all partitions, whatever the session
    says; its setting comes back afterwards."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "static")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def incremental_replace_table(spark: SparkSession, df: DataFrame, table: str, column: str,
                              run_date: dt.date | str, safe_cast: bool = False) -> LoadResult:
    """Replace the ``column = run_date`` partition of a catalog table with ``df``
    (LOD-2), in one statement on that partition alone."""
    check_identifier(table, "table")
    check_identifier(column, "column")
    if not spark.catalog.tableExists(table):
        raise SpecError(f"table {table} does not exist; load it in full first")
    if [c.lower() for c in _partition_columns(spark, table)] != [column.lower()]:
        raise SpecError(f"table {table} is not partitioned by {column!r}; load it in full first")
    new = stamp(df, column, run_date)
    schema = T.StructType([f for f in spark.table(table).schema.fields if f.name.lower() != column.lower()])
    seen = Observation()  # counted by the write itself: the source runs once
    rows = align_to_target(new, schema, safe_cast).observe(seen, F.count(F.lit(1)).alias("n"))
    value = dt.date.fromisoformat(_partition_value(run_date)).isoformat()
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({column} = DATE '{value}') SELECT * FROM {{rows}}", rows=rows)
    return LoadResult(table, "incremental", run_date, int(seen.get.get("n") or 0))


# --------------------------------------------------------------------------- JDBC

def full_load_jdbc(df: DataFrame, profile: ConnectionProfile, table: str) -> None:
    """Overwrite a JDBC table keeping its definition (LOD-1, D15)."""
    write_jdbc(df, profile, check_identifier(table, "table"), mode="overwrite")


def incremental_replace_jdbc(spark: SparkSession, df: DataFrame, profile: ConnectionProfile,
                             table: str, column: str, run_date: dt.date | str,
                             staging_table: str | None = None) -> LoadResult:
    """Replace one date slice of a JDBC table atomically (LOD-2, SNK-5).

    1. executors write the stamped slice to a staging table: ``staging_table``
       (overwritten and kept), else one of a fresh name, dropped at the end;
    2. the driver opens one connection: ``DELETE FROM t WHERE col = ?`` then
       ``INSERT INTO t (cols) SELECT cols FROM staging``, one commit, rollback on
       any error.  Only column names present in the target are used.
    """
    check_identifier(table, "table")
    check_identifier(column, "column")
    staging = check_identifier(staging_table or f"{table}_stg_{uuid.uuid4().hex[:12]}", "staging table")
    target_cols = [f.name for f in table_schema(spark, profile, table).fields]
    if column.lower() not in {c.lower() for c in target_cols}:
        raise SpecError(f"{table} has no column {column!r}")
    new = stamp(df, column, run_date)
    cols = [c for c in target_cols if c.lower() in {x.lower() for x in new.columns}]
    for c in cols:
        check_identifier(c, "column")
    write_jdbc(new.select(*cols), profile, staging, mode="overwrite")

    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in profile.jdbc_options().items():
        if k not in ("url", "driver"):
            props.setProperty(k, v)
    if profile.driver:
        jvm.java.lang.Class.forName(profile.driver)
    conn = jvm.java.sql.DriverManager.getConnection(profile.url, props)
    try:
        conn.setAutoCommit(False)
        delete = conn.prepareStatement(f"DELETE FROM {table} WHERE {column} = ?")
        delete.setDate(1, jvm.java.sql.Date.valueOf(_partition_value(run_date)))
        delete.executeUpdate()
        col_list = ", ".join(cols)
        insert = conn.prepareStatement(
            f"INSERT INTO {table} ({col_list}) SELECT {col_list} FROM {staging}")
        inserted = insert.executeUpdate()
        conn.commit()
        return LoadResult(table, "incremental", run_date, int(inserted))
    except Exception:
        conn.rollback()
        raise
    finally:
        try:
            if not staging_table:
                conn.createStatement().executeUpdate(f"DROP TABLE {staging}")
                conn.commit()
        finally:
            conn.close()


# --------------------------------------------------------------------------- dispatch


def load(spark: SparkSession, df: DataFrame, spec: LoadSpec, run_date: dt.date | str | None,
         profile: ConnectionProfile | None = None) -> LoadResult:
    """Write ``df`` as ``spec`` says: full or incremental, files, catalog table or JDBC."""
    if spec.format == "jdbc":
        if profile is None:
            raise SpecError("a jdbc target needs a connection profile")
        if spec.load_type is LoadType.INCREMENTAL:
            return incremental_replace_jdbc(spark, df, profile, spec.target,
                                            spec.incremental_column, run_date)
        full_load_jdbc(df, profile, spec.target)
        return LoadResult(spec.target, "full", run_date, None)
    if spec.load_type is LoadType.INCREMENTAL:
        if run_date is None:
            raise SpecError("an incremental load needs a run_date")
        if spec.format == "table":
            return incremental_replace_table(spark, df, spec.target, spec.incremental_column, run_date)
        return incremental_replace_files(spark, df, spec.target, spec.incremental_column,
                                         run_date, spec.format)
    if spec.incremental_column and spec.incremental_column.lower() not in [c.lower() for c in df.columns]:
        if run_date is None:
            raise SpecError(f"the rows lack {spec.incremental_column!r}: a full load needs a run_date to stamp them")
        df = stamp(df, spec.incremental_column, run_date)
    if spec.format == "table":
        full_load_table(df, spec.target, spec.partition_by)
    else:
        full_load_files(df, spec.target, spec.format, spec.partition_by)
    return LoadResult(spec.target, "full", run_date, None)

