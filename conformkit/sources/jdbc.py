"""JDBC sources (SRC-7..10, PRJ-6, PRJ-7, FLT-3).

A source query is always wrapped as a ``dbtable`` subquery, never passed as
the ``query`` option: Spark refuses ``query`` together with
``partitionColumn`` (D14), and the subquery form lets Spark push column
pruning and filters into the database.  Reads are parallel only when a
partition column and bounds (or explicit predicates) are given; otherwise a
single task reads the whole result.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from conformkit.specs import ConnectionProfile, SpecError, check_identifier

DEFAULT_FETCHSIZE = 10000
_PART = r"""(?:[\w$#]+|"[^"]+"|`[^`]+`|\[[^\]]+\])"""
TABLE_NAME = re.compile(rf"{_PART}(?:\.{_PART})*")


def subquery(query: str, alias: str = "src") -> str:
    """A table name, or a subquery with its own alias, as it is; anything else is
    SQL and becomes a subquery."""
    q = query.strip().rstrip(";")
    if TABLE_NAME.fullmatch(q) or q.startswith("("):
        return q
    end = "\n" if "--" in q else ""  # a last line may be a comment
    return f"({q}{end}) {alias}"


def read_query(spark: SparkSession, profile: ConnectionProfile, query: str,
               partition_column: str | None = None, lower_bound: int | None = None,
               upper_bound: int | None = None, num_partitions: int | None = None,
               fetchsize: int | None = None,
               predicates: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``query`` (SQL text or a table name) (SRC-7, SRC-8).

    Range partitioning applies only when all four of partition column, bounds
    and partition count are given (as the reference does); bounds only set the
    stride, rows outside them are still read.  ``predicates`` gives one
    partition per WHERE clause instead.
    """
    opts = profile.jdbc_options()
    opts["dbtable"] = subquery(query)
    opts["fetchsize"] = str(fetchsize or opts.get("fetchsize") or DEFAULT_FETCHSIZE)
    if predicates:
        if partition_column:
            raise SpecError("use either predicates or a partition column, not both")
        props = {k: v for k, v in opts.items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(opts["url"], opts["dbtable"], predicates=list(predicates),
                               properties=props)
    parts = (partition_column, lower_bound, upper_bound, num_partitions)
    if all(p is not None for p in parts):
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    elif any(p is not None for p in parts):
        raise SpecError("range reads need partition_column, lower_bound, upper_bound "
                        "and num_partitions together")
    return spark.read.format("jdbc").options(**opts).load()


def read_query_parallel(spark: SparkSession, profile: ConnectionProfile, query: str,
                        partition_column: str, num_partitions: int,
                        fetchsize: int | None = None) -> DataFrame:
    """SRC-8 with the bounds discovered first: one ``min/max`` query runs inside
    the database (one row back), then ``num_partitions`` tasks each read one
    stride of the numeric ``partition_column``.  The reference's only caller
    passes no bounds, so its reads run in a single task."""
    col = check_identifier(partition_column, "partition column")
    bounds = read_query(spark, profile,
                        f"SELECT min({col}) AS lo, max({col}) AS hi FROM {subquery(query, 'b')}",
                        fetchsize=fetchsize).first()
    if bounds is None or bounds["lo"] is None:
        return read_query(spark, profile, query, fetchsize=fetchsize)
    lo, hi = int(bounds["lo"]), int(bounds["hi"])
    return read_query(spark, profile, query, partition_column=col, lower_bound=lo,
                      upper_bound=hi + 1, num_partitions=max(1, min(num_partitions, hi - lo + 1)),
                      fetchsize=fetchsize)


def read_named(spark: SparkSession, profiles: dict[str, ConnectionProfile],
               connection_name: str, query: str, **kw) -> DataFrame:
    """SRC-7 through a named connection profile (SRC-9)."""
    if connection_name not in profiles:
        raise SpecError(f"unknown connection {connection_name!r}")
    return read_query(spark, profiles[connection_name], query, **kw)


def table_schema(spark: SparkSession, profile: ConnectionProfile, table: str) -> T.StructType:
    """The target's schema without reading rows (SRC-10, FLT-1): Spark asks the
    database for the relation's columns only; no job runs."""
    return read_query(spark, profile, table).schema
