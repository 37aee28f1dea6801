"""Query catalogue: every operator of the survey run on the driver's test tables.

Each entry is a callable ``(spark, sf_dir) -> DataFrame`` plus, where the
result is expressible in plain SQL, the equivalent DuckDB query over the same
tables (the correctness oracle).  Output columns are aliased identically on
both sides; money is summed as ``decimal(18,2)`` and the total cast to
double so both engines give the same bits.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class CatalogEntry:
    name: str
    fn: QueryFn
    sql: str | None
    operators: tuple[str, ...]


_ENTRIES: dict[str, CatalogEntry] = {}


def query(name: str, operators: str, sql: str | None = None):
    """Register ``fn`` under ``name`` with its oracle SQL (None: rows-only)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in _ENTRIES:
            raise ValueError(f"query {name!r} registered twice")
        _ENTRIES[name] = CatalogEntry(name, fn, sql, tuple(operators.split()))
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def entries() -> dict[str, CatalogEntry]:
    _load()
    return dict(_ENTRIES)


def queries() -> dict[str, QueryFn]:
    return {k: e.fn for k, e in entries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: e.sql for k, e in entries().items() if e.sql is not None}


def _load() -> None:
    # Importing the modules registers their queries.
    from conformkit.plans import queries_columns, queries_core, queries_io, queries_tables  # noqa: F401
