"""File readers (SRC-1..6, SRC-11..15).

Each returns a lazy DataFrame; Catalyst prunes columns and pushes filters into
the scan (Parquet: ``PushedFilters`` / ``ReadSchema``; CSV: only the needed
columns are parsed).  Schemas are declared wherever we know them so no
inference pass runs over the data.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conformkit.session import MAX_SMALL_FILE_BYTES, path_exists, read_small_text
from conformkit.specs import SourceSpec, SpecError, build_schema

CORRUPT_COLUMN = "_corrupt_record"

# How sinks.files.write_csv writes free text, for reading it back exactly: quotes
# doubled inside quotes, blanks kept, lines ended by \n alone.  A null is nothing
# between two separators and an empty text is "", so the null marker of the reader
# must be something that no field holds.
CSV_TEXT = {"escape": '"', "lineSep": "\n", "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false", "nullValue": "\x00null\x00", "emptyValue": ""}


def _csv_reader(spark: SparkSession, multiline: bool, options: Mapping[str, Any]):
    """Quotes inside quotes are doubled, as RFC 4180 and ``write_csv`` have it (pass
    ``escape`` for files that use a backslash).  With ``multiline`` a quoted value may
    hold line breaks, and fields are read just as ``write_csv`` wrote them; a file is
    then read by one task, so write such data as many files (``rows_per_file``)."""
    fixed = {**CSV_TEXT, "multiLine": "true"} if multiline else {"escape": CSV_TEXT["escape"]}
    return spark.read.options(**{**fixed, **options})


def as_schema(schema: Any) -> T.StructType | str | None:
    """Accept a StructType, a DDL string or config fields [(name, type)]."""
    if schema is None or isinstance(schema, (T.StructType, str)):
        return schema
    return build_schema(schema)


def read_csv_strings(spark: SparkSession, path: str, multiline: bool = False, **options) -> DataFrame:
    """CSV with a header, every column a string (SRC-1).  A UTF-8 BOM at the
    start of the file is dropped by the reader (D22).  ``multiline``: records may
    span lines, and blanks, empty texts and nulls are told apart."""
    return _csv_reader(spark, multiline, options).csv(path, header=True)


def read_csv_ddl(spark: SparkSession, path: str, ddl: str, header: bool = False,
                 multiline: bool = False, **options) -> DataFrame:
    """CSV bound to a DDL schema (SRC-2).  ``header`` is explicit: without it a
    header line would be read as a data row (D13)."""
    return _csv_reader(spark, multiline, options).schema(ddl).csv(path, header=header)


def read_csv_typed(spark: SparkSession, path: str, schema: Any, header: bool = True,
                   check_header: bool = True, keep_rejects: bool = False,
                   multiline: bool = False, **options) -> DataFrame:
    """CSV with a header and an explicit schema (SRC-3).

    ``check_header`` sets ``enforceSchema=false`` so a header that disagrees with
    the schema fails the read instead of binding columns by position (D12).
    ``keep_rejects`` adds ``_corrupt_record``: the raw line of every row with a
    value that did not parse (such values read as null either way).
    """
    st = as_schema(schema)
    if isinstance(st, str):
        st = T._parse_datatype_string(st)
    if keep_rejects:
        st = T.StructType(list(st.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)])
        options.setdefault("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    reader = _csv_reader(spark, multiline, options).schema(st)
    if header:
        reader = reader.option("enforceSchema", str(not check_header).lower())
    return reader.csv(path, header=header)


def csv_reject_counts(spark: SparkSession, path: str, schema: Any, **options) -> DataFrame:
    """file, n_rows, n_corrupt, n_values (values read) of every CSV file: how many
    of its records hold a value that does not parse, or too few or many values.
    One pass; each task sends one row per file.  A file without records has no row."""
    rows = read_csv_typed(spark, path, schema, keep_rejects=True, **options)
    values = sum((F.col(f"`{c}`").isNotNull().cast("int") for c in rows.columns if c != CORRUPT_COLUMN), F.lit(0))
    # A record is known to be corrupt only if all of its values are parsed, and Spark
    # parses just the columns in use: so the test itself uses all of them.
    read = rows.select(F.col("_metadata.file_name").alias("file"), values.alias("n"),
                       ((values >= 0) & F.col(CORRUPT_COLUMN).isNotNull()).alias("corrupt"))
    return read.groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("corrupt").alias("n_corrupt"),
                                    F.sum("n").alias("n_values"))


def read_csv_inferred(spark: SparkSession, path: str, multiline: bool = False, **options) -> DataFrame:
    """CSV with inferred types (SRC-4), as ``pandas.read_csv`` does.  Inference is
    a full extra pass over the data; prefer a declared schema at scale (or set
    ``samplingRatio``)."""
    return _csv_reader(spark, multiline, options).csv(path, header=True, inferSchema=True)


def rows(spark: SparkSession, data: Sequence[Sequence[Any]], schema: Any) -> DataFrame:
    """A table from literal rows (SRC-5), for small fixed lookups."""
    return spark.createDataFrame(list(data), as_schema(schema))


def empty(spark: SparkSession, schema: Any) -> DataFrame:
    """A typed table with no rows (SRC-6).  Not needed as a union seed."""
    return spark.createDataFrame([], as_schema(schema))


def read_text_lines(spark: SparkSession, path: str, escaped: bool = False, **options) -> DataFrame:
    """One row per line, column ``value`` (SRC-15).  ``escaped`` undoes the escapes
    of ``write_text(..., newlines="escape")``."""
    lines = spark.read.options(**options).text(path)
    return lines.select(unescape_lines(F.col("value")).alias("value")) if escaped else lines


def unescape_lines(c: Column) -> Column:
    """Undo ``sinks.files.escape_lines``.  An escaped text holds no NUL, so NUL and a
    letter stand for a backslash or a NUL until the other escapes are undone."""
    for mark, text in (("\\\\", "\x00b"), ("\\0", "\x00z"), ("\\n", "\n"), ("\\r", "\r"),
                       ("\x00b", "\\"), ("\x00z", "\x00")):
        c = F.replace(c, F.lit(mark), F.lit(text))
    return c


def read_text_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file holding its whole text (SRC-11): no line-order question
    across partitions.  Each file is read by one task, so this is for files of
    bounded size (configs, documents)."""
    return spark.read.text(path, wholetext=True)


def document_lines(doc: Column | str = "value") -> Column:
    """The lines of a whole-text document, in file order (SRC-11), like
    ``text.splitlines()`` for newline-ended lines: a final newline adds no
    empty line."""
    d = F.col(doc) if isinstance(doc, str) else doc
    parts = F.split(d, "\n")
    return F.when(d.endswith("\n"), F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def read_json_documents(spark: SparkSession, path: str, schema: Any = None,
                        mode: str = "PERMISSIVE", **options) -> DataFrame:
    """Multi-line JSON (SRC-12): each file is one JSON value; a top-level array
    gives one row per element.  Unsplittable, one task per file."""
    reader = spark.read.options(**options).option("multiLine", True).option("mode", mode)
    st = as_schema(schema)
    if st is not None:
        reader = reader.schema(st)
    return reader.json(path)


def read_json_lines(spark: SparkSession, path: str, schema: Any = None, **options) -> DataFrame:
    reader = spark.read.options(**options)
    st = as_schema(schema)
    if st is not None:
        reader = reader.schema(st)
    return reader.json(path)


def read_parquet(spark: SparkSession, path: str, schema: Any = None, **options) -> DataFrame:
    reader = spark.read.options(**options)
    st = as_schema(schema)
    if st is not None:
        reader = reader.schema(st)
    return reader.parquet(path)


def read_config(spark: SparkSession, path: str, limit: int = MAX_SMALL_FILE_BYTES) -> dict:
    """A JSON config file as a dict (SRC-13, SNK-7).

    Read on the driver through the Hadoop FileSystem API, so local, HDFS and
    object-store paths behave alike and no Spark job runs; files above
    ``limit`` bytes are refused, as no config is that large.  A folder holding one data file (as Spark writes
    text) is accepted too.
    """
    if not path_exists(spark, path):
        raise SpecError(f"config {path!r} does not exist")
    try:
        text = read_small_text(spark, path, limit)
    except ValueError as e:
        raise SpecError(f"config {path!r}: {e}") from e
    try:
        return json.loads(text)
    except json.JSONDecodeError as e:
        raise SpecError(f"config {path!r} is not valid JSON: {e}") from e


def _is_missing_path(e: AnalysisException) -> bool:
    cond = getattr(e, "getCondition", None) or getattr(e, "getErrorClass", None)
    name = cond() if cond else None
    return name == "PATH_NOT_FOUND" or "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e)


def optional_source(spark: SparkSession, read, schema: Any) -> DataFrame:
    """``read()`` if its path exists, else an empty table of ``schema`` (SRC-14).

    Only a missing path is forgiven; any other error still fails the job.
    """
    try:
        return read()
    except AnalysisException as e:
        if not _is_missing_path(e):
            raise
        return empty(spark, schema)


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Read one ``SourceSpec`` (csv / parquet / json / json_documents / text /
    table / jdbc)."""
    fmt = spec.format
    opts: dict[str, Any] = dict(spec.options)
    if fmt == "csv":  # a spec's options come from JSON
        opts["multiline"] = str(opts.pop("multiline", False)).lower() == "true"
    if fmt != "table" and not spec.path:
        raise SpecError(f"source {spec.name!r} has no path")

    def read() -> DataFrame:
        if fmt == "csv":
            if spec.schema is None:
                return read_csv_strings(spark, spec.path, **opts)
            if isinstance(spec.schema, str) and not spec.header:
                return read_csv_ddl(spark, spec.path, spec.schema, header=False, **opts)
            return read_csv_typed(spark, spec.path, spec.schema, header=spec.header, **opts)
        if fmt == "parquet":
            return read_parquet(spark, spec.path, spec.schema, **opts)
        if fmt == "json":
            return read_json_lines(spark, spec.path, spec.schema, **opts)
        if fmt == "json_documents":
            return read_json_documents(spark, spec.path, spec.schema, **opts)
        if fmt == "text":
            return read_text_lines(spark, spec.path, **opts)
        if fmt == "table":
            return spark.table(spec.path or spec.name)
        if fmt == "jdbc":
            # path = source SQL or table; options = connection profile keys plus, for
            # a parallel read, partition_column and num_partitions (and the bounds,
            # else they are asked of the database) or predicates; and fetch_size.
            from conformkit.sources import jdbc
            from conformkit.specs import ConnectionProfile
            o = dict(opts)
            part_col, n_parts, low, high, fetch, clauses = (o.pop(k, None) for k in (
                "partition_column", "num_partitions", "lower_bound", "upper_bound", "fetch_size", "predicates"))
            profile, fetch = ConnectionProfile.from_dict(o), int(fetch) if fetch else None
            if isinstance(clauses, str):
                raise SpecError(f"source {spec.name!r}: predicates must be a list of WHERE clauses")
            if (low is None) != (high is None):
                raise SpecError(f"source {spec.name!r}: lower_bound and upper_bound go together")
            if clauses or low is not None:
                return jdbc.read_query(spark, profile, spec.path, part_col, None if low is None else int(low),
                                       None if high is None else int(high), int(n_parts) if n_parts else None,
                                       fetchsize=fetch, predicates=clauses)
            if part_col and n_parts:
                return jdbc.read_query_parallel(spark, profile, spec.path, part_col, int(n_parts), fetch)
            if part_col or n_parts:
                raise SpecError(f"source {spec.name!r}: partition_column and num_partitions go together")
            return jdbc.read_query(spark, profile, spec.path, fetchsize=fetch)
        raise SpecError(f"source {spec.name!r}: unsupported format {fmt!r}")

    if spec.optional:
        if spec.schema is None:
            raise SpecError(f"optional source {spec.name!r} needs a schema")
        return optional_source(spark, read, spec.schema)
    return read()

