"""Row positions and pairing by position over whole tables (WIN-1, WIN-2, JON-3).

``enumerate`` and ``zip`` over a table need gapless numbers in one order.  A window
over all rows would put them into one task.  Here the rows are sorted by range (as
any global sort), written once, and numbered by file: a file's offset is the number
of rows in the files before it, and Parquet's own row index numbers the rows inside
it, whichever task reads them.  What reaches the driver is one count per file, as
the scheduler itself holds one record per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conformkit.operators.ordering import sort_rows
from conformkit.session import scratch_path
from conformkit.specs import SpecError

# An offset is a file name and a number, some 100 bytes: up to this many are sent to
# every task (6 MB), more are joined as a table.
BROADCAST_FILES = 1 << 16


def number_rows(df: DataFrame, order_by: Sequence[Column | str] = (), name: str = "pos",
                start: int = 0, broadcast_files: int = BROADCAST_FILES) -> DataFrame:
    """``df`` with a gapless ``name`` from ``start`` in the given order (WIN-1).

    Rows tied on the order are numbered in some order; without ``order_by`` rows
    keep the order of their tasks.  This is an action: rows are written to the
    scratch folder and read back, so their numbers stay as they are, also when an
    executor is lost.  An empty table gives an empty result."""
    if name.lower() in {c.lower() for c in df.columns}:
        raise SpecError(f"number_rows: the rows already have a column {name!r}")
    spark = df.sparkSession
    path = scratch_path(spark, "numbered")
    (sort_rows(df, order_by) if order_by else df).write.parquet(path)
    rows = spark.read.schema(df.schema).parquet(path)
    file, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    # Names sort as the tasks that wrote them, and then as their files.
    counts = sorted((r["file"], r["n"]) for r in rows.groupBy(file.alias("file")).agg((F.max(row) + 1).alias("n")).collect())
    if not counts:
        return rows.withColumn(name, F.lit(None).cast("long"))
    offsets = spark.createDataFrame(
        [(f, start + before) for (f, _), before in zip(counts, accumulate((n for _, n in counts), initial=0))],
        "__file string, __offset long")
    if len(counts) <= broadcast_files:
        offsets = F.broadcast(offsets)
    return (rows.select("*", file.alias("__of"), row.alias("__row")).join(offsets, F.col("__of") == F.col("__file"))
            .select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__offset") + F.col("__row")).alias(name)))


def pair_by_position(frames: Sequence[tuple[DataFrame, Sequence[Column | str]]], name: str = "pos") -> DataFrame:
    """The frames' rows side by side by their position in each one's own order, as
    many as the shortest has (JON-3).  Each position is one key, so the join deals
    rows evenly."""
    if len(frames) < 2:
        raise SpecError("pair_by_position needs two or more frames")
    names = [c.lower() for df, _ in frames for c in df.columns]
    if len(set(names)) != len(names):
        raise SpecError(f"pair_by_position: columns repeat: {sorted({c for c in names if names.count(c) > 1})}")
    out, *rest = [number_rows(df, order, name) for df, order in frames]
    for other in rest:
        out = out.join(other, name)
    return out


def first_position(numbered: DataFrame, condition: Column, name: str = "pos") -> DataFrame:
    """One row, ``first_pos``: the least position of a row that fits, null if none
    (WIN-2)."""
    return numbered.where(condition).agg(F.min(name).alias("first_pos"))
