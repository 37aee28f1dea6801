"""Scratch locations and small session helpers.

Intermediate files (round-trip tests of file formats, staging slices) go under the
shared folder the cluster names in ``spark.checkpoint.dir``.  A cluster that names
none is refused; a local session uses a folder below its warehouse.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


SCRATCH_PREFIX = "conformkit_scratch_"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/conformkit/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def persisted(df: DataFrame,
              level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Cache a frame for several actions and always release it afterwards (PRJ-16).

    A lost executor only drops cached blocks; Spark recomputes them from lineage.
    """
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def hadoop_path(spark: SparkSession, path: str):
    """(FileSystem, Path) for a path, through the session's Hadoop configuration."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = hadoop_path(spark, path)
    return bool(fs.exists(jpath))


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete a path (driver-side metadata call)."""
    fs, jpath = hadoop_path(spark, path)
    return bool(fs.delete(jpath, True))


def swap_in(spark: SparkSession, staging: str, target: str, aside: str) -> None:
    """Move ``staging`` to ``target``, keeping the old target as ``aside`` until the
    new one is in place (and restoring it if the second rename fails)."""
    fs, t = hadoop_path(spark, target)
    _, s = hadoop_path(spark, staging)
    _, old = hadoop_path(spark, aside)
    had_target = bool(fs.exists(t))
    if had_target and not fs.rename(t, old):
        raise OSError(f"cannot move {target} aside")
    if not fs.rename(s, t):
        if had_target:
            fs.rename(old, t)
        raise OSError(f"cannot move {staging} to {target}")
    if had_target:
        fs.delete(old, True)


def scratch_table(spark: SparkSession, name: str) -> str:
    """A fresh table name in the session catalog (current database)."""
    return f"{SCRATCH_PREFIX}{name}_{uuid.uuid4().hex}"


def clean_scratch(spark: SparkSession) -> list[str]:
    """Delete every scratch folder and scratch table of earlier and present runs and
    say which.  Call it when no frame that reads them is still in use: frames are
    lazy, so a query cannot clean up after itself."""
    found = []
    fs, root = hadoop_path(spark, f"{checkpoint_root(spark)}/conformkit")
    if fs.exists(root):
        found += [str(st.getPath().toString()) for st in fs.listStatus(root)]
        fs.delete(root, True)
    for t in spark.catalog.listTables():
        if not t.isTemporary and t.name.startswith(SCRATCH_PREFIX):
            spark.sql(f"DROP TABLE IF EXISTS `{t.name}`")
            found.append(t.name)
    return found


# A config file read or written on the driver must stay config-sized.
MAX_SMALL_FILE_BYTES = 16 * 1024 * 1024


def read_small_text(spark: SparkSession, path: str, limit: int = MAX_SMALL_FILE_BYTES) -> str:
    """The text of one small file (a config), read on the driver through the
    Hadoop FileSystem API, so local, HDFS and object-store paths behave alike
    and no Spark job runs.  Refuses files above ``limit`` bytes."""
    fs, jpath = hadoop_path(spark, path)
    status = fs.getFileStatus(jpath)
    if status.isDirectory():
        files = [st for st in fs.listStatus(jpath)
                 if st.isFile() and not st.getPath().getName().startswith(("_", "."))]
        if len(files) != 1:
            raise ValueError(f"{path}: expected one data file, found {len(files)}")
        status, jpath = files[0], files[0].getPath()
    if status.getLen() > limit:
        raise ValueError(f"{path}: {status.getLen()} bytes is not a config-sized file")
    jvm = spark.sparkContext._jvm
    stream = fs.open(jpath)
    try:
        data = jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
    finally:
        stream.close()
    return bytes(data).decode("utf-8-sig")


def write_small_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small file (a config) from the driver, replacing it."""
    data = text.encode("utf-8")
    if len(data) > MAX_SMALL_FILE_BYTES:
        raise ValueError("write_small_text is for config-sized text")
    fs, jpath = hadoop_path(spark, path)
    out = fs.create(jpath, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
