"""File writers (SNK-1, SNK-2, SNK-6, SNK-8) and a JSON-document writer.

Writes go through Spark's commit protocol: every task writes to a staging
location and the job commits at the end, so a lost executor's task is simply
re-run and no partial file becomes visible.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conformkit.session import delete_path, swap_in
from conformkit.specs import SpecError


# Quotes doubled inside quotes, blanks kept, lines ended by \n alone.
# Nulls are written as nothing, empty texts as "" (Spark's defaults).
CSV_TEXT = {"escape": '"', "lineSep": "\n", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True,
              rows_per_file: int | None = None, **options) -> None:
    """CSV with a header (SNK-1).  Columns of unknown (void) type cannot be
    written; conform first so nulls are typed (D11).

    Any text survives: line breaks and separators are quoted, quotes doubled,
    blanks and empty texts kept (read it with ``multiline=True``).  A file whose
    values hold line breaks is read by one task; ``rows_per_file`` bounds it."""
    if rows_per_file:
        options["maxRecordsPerFile"] = rows_per_file
    df.write.mode(mode).options(**{**CSV_TEXT, **options}).csv(path, header=header)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append_partitioned(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Append Parquet partitioned by ``partition_by`` (SNK-2).

    Rows are clustered by the partition values first so each task writes few
    files.  The REBALANCE hint (not ``repartition``) lets AQE split a value that
    holds a large share of the rows over several tasks and merge small ones,
    so one hot value does not become one huge task.  Read such a folder back
    with its schema: a folder written with zero rows has nothing to infer from.
    """
    (df.hint("rebalance", *partition_by)
       .write.mode("append").partitionBy(*partition_by).parquet(path))


def append_batch(df: DataFrame, path: str, batch: str, partition_by: Sequence[str] = (),
                 column: str = "batch_id") -> None:
    """Append one batch (SNK-2) so that running it again leaves one copy.

    A batch is the folder ``batch_id=<batch>`` of the target, partitioned inside by
    ``partition_by``.  It is written under a hidden name first and then takes the
    place of an earlier run of the same batch in whole, also where the new run has
    fewer partitions or no rows; other batches are never touched.  Readers get the
    batch as a column, and filters on it or on the inner columns skip folders."""
    if column.lower() in {c.lower() for c in df.columns}:
        raise SpecError(f"append_batch: the rows already have a column {column!r}")
    spark = df.sparkSession
    folder = f"{column}={quote(str(batch), safe='')}"
    staging = f"{path.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    writer = (df.hint("rebalance", *partition_by) if partition_by else df).write
    try:
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{staging}/new")
        swap_in(spark, f"{staging}/new", f"{path.rstrip('/')}/{folder}", f"{staging}/old")
    finally:
        delete_path(spark, staging)


def escape_lines(c: Column) -> Column:
    """A text on one line: backslashes doubled, line breaks as \\n and \\r, NUL as \\0."""
    for char, mark in (("\\", "\\"), ("\n", "n"), ("\r", "r"), ("\x00", "0")):
        c = F.replace(c, F.lit(char), F.lit("\\" + mark))
    return c


def write_text(df: DataFrame, path: str, column: str | None = None, mode: str = "overwrite",
               newlines: str = "refuse") -> None:
    """One line per row of a single string column (SNK-8); a null is an empty line.

    A value with a line break would become several rows.  By default it fails the
    job; ``newlines="escape"`` writes it on one line (``escape_lines``), to be read
    by ``read_text_lines(escaped=True)``."""
    value = F.col(f"`{column or df.columns[0]}`").cast("string")
    if newlines == "escape":
        value = escape_lines(value)
    elif newlines == "refuse":
        value = F.when(value.rlike("[\n\r]"), F.raise_error(F.lit(
            f"write_text: a value of column {column or df.columns[0]!r} holds a line break; use newlines='escape'"))).otherwise(value)
    else:
        raise SpecError(f"write_text: newlines is 'refuse' or 'escape', not {newlines!r}")
    df.select(value.alias("value")).write.mode(mode).text(path)


DOCUMENT_BYTES = 32 << 20


def write_json_documents(df: DataFrame, path: str, mode: str = "overwrite",
                         document_bytes: int = DOCUMENT_BYTES) -> None:
    """Write multi-line JSON array documents (the shape SRC-12 reads), one per file.

    A task lays its records end to end and closes a document once it holds
    ``document_bytes`` bytes (a larger record is a document of its own), so
    documents are alike in size whatever the width of the rows, rows keep their
    order and nothing is shuffled.  Only one document is held in a task at a time.
    A task without rows writes no document."""
    records = df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"))

    def documents(batches):
        held, size = [], 0
        for batch in batches:
            for record in batch.column(0).to_pylist():
                n = len(record.encode())
                if held and size + n > document_bytes:
                    yield document(held)
                    held, size = [], 0
                held.append(record)
                size += n + 2
        if held:
            yield document(held)

    def document(held):
        return pa.RecordBatch.from_arrays([pa.array(["[\n" + ",\n".join(held) + "\n]"])], ["value"])

    (records.mapInArrow(documents, "value string").write
     .option("maxRecordsPerFile", 1).mode(mode).text(path))


def preview(df: DataFrame, n: int = 20, order_by: Sequence[str] = ()) -> DataFrame:
    """First ``n`` rows (SNK-6, SRT-1); ordered when keys are given so the answer
    is stable.  Planned as a per-partition top-n and a small merge."""
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n)
