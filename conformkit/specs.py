"""Validated job specifications, built from the JSON shapes the reference uses.

All of this is driver-side metadata (a few kilobytes); no data passes through it.

Config shapes accepted (keys as in the reference's files):

* mapping:   ``{"data_sources": [{"source_name", "path", "transformations":
               [{"column_name", "expression"}]}], "output_path"}``
* roll-up:   ``{"sourceCSVPath", "targetTable", "readSchema": [{"col_name",
               "col_type"}], "transformations", "read_db_tables": {name: sql}}``
* load:      ``{"targetTable", "load_type", "incremental_column", "transformations"}``
* services:  ``{"services": ["pkg.Name", ...]}``
* profiles:  ``{"source_db_configs": {...}, "target_db_configs": {...}}``
"""

from __future__ import annotations

import enum
import re
import os
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T


class SpecError(ValueError):
    """A configuration that cannot be run as written."""


# --------------------------------------------------------------------------- types

# The type names the roll-up config uses, lower-cased, and the
# Spark type each one means.  Any other name falls back to string (as in the
# reference), unless it parses as a Spark DDL type.
_CONFIG_TYPE_NAMES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
}


_DDL_PRIMITIVES: dict[str, T.DataType] = {
    "varchar": T.StringType(), "bigint": T.LongType(), "long": T.LongType(),
    "integer": T.IntegerType(), "smallint": T.ShortType(), "short": T.ShortType(),
    "tinyint": T.ByteType(), "byte": T.ByteType(), "float": T.FloatType(),
    "real": T.FloatType(), "boolean": T.BooleanType(), "bool": T.BooleanType(),
    "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(),
    "binary": T.BinaryType(), "decimal": T.DecimalType(10, 0),
}
_DECIMAL = re.compile(r"^(?:decimal|numeric|dec)\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)$")


def parse_type(name: str | T.DataType) -> T.DataType:
    """Type name from config → Spark type (PRJ-9).

    Config names are matched without case; primitive DDL names and
    ``decimal(p,s)`` are mapped directly (no session needed); nested types
    (``array<string>`` ...) are parsed by Spark.  A name Spark cannot parse
    becomes ``string``, as in the reference.
    """
    if isinstance(name, T.DataType):
        return name
    key = str(name).strip().lower()
    if key in _CONFIG_TYPE_NAMES:
        return _CONFIG_TYPE_NAMES[key]
    if key in _DDL_PRIMITIVES:
        return _DDL_PRIMITIVES[key]
    m = _DECIMAL.match(key)
    if m:
        return T.DecimalType(int(m.group(1)), int(m.group(2) or 0))
    from pyspark import SparkContext
    if SparkContext._active_spark_context is None:
        raise SpecError(f"type {name!r} needs an active Spark session to parse")
    try:
        return T._parse_datatype_string(str(name).strip())  # field names keep their case
    except Exception:  # noqa: BLE001 - documented fallback
        return T.StringType()


def build_schema(fields: Iterable[Mapping[str, Any]] | Iterable[tuple[str, Any]]) -> T.StructType:
    """Schema from config, every field nullable (PRJ-8).

    Accepts ``[{"col_name": .., "col_type": ..}]`` or ``[(name, type)]``.
    """
    out = []
    for f in fields:
        if isinstance(f, Mapping):
            name, typ = f["col_name"], f.get("col_type", "string")
        else:
            name, typ = f
        out.append(T.StructField(str(name), parse_type(typ), True))
    names = [f.name.lower() for f in out]
    dupes = sorted({n for n in names if names.count(n) > 1})
    if dupes:
        raise SpecError(f"schema repeats column names (ignoring case): {dupes}")
    return T.StructType(out)


# --------------------------------------------------------------------------- identifiers

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_$]*(\.[A-Za-z_][A-Za-z0-9_$]*){0,2}$")


def check_identifier(name: str, what: str = "identifier") -> str:
    """Table/column names are spliced into SQL text, so they must be plain
    identifiers (values always go through bind parameters)."""
    if not _IDENT.match(name or ""):
        raise SpecError(f"unsafe {what}: {name!r}")
    return name


# --------------------------------------------------------------------------- specs

@dataclass(frozen=True)
class Transform:
    """``column_name := expression``; the column name wins over any alias in
    the expression (D8)."""

    column_name: str
    expression: str

    @classmethod
    def from_dict(cls, d: Mapping[str, Any]) -> Transform:
        try:
            return cls(str(d["column_name"]), str(d["expression"]))
        except KeyError as e:
            raise SpecError(f"transformation lacks {e.args[0]!r}: {dict(d)}") from None


def transforms_from(items: Iterable[Mapping[str, Any] | Transform] | None) -> tuple[Transform, ...]:
    return tuple(t if isinstance(t, Transform) else Transform.from_dict(t) for t in (items or ()))


@dataclass(frozen=True)
class SourceSpec:
    """One input of a mapping or load job.

    ``format`` is one of csv, parquet, json, text, jdbc, table.  ``schema`` is a
    DDL string or a list of (name, type); ``header`` is explicit (D13).
    ``optional`` sources that are absent read as an empty table of ``schema``
    (SRC-14).
    """

    name: str
    path: str | None = None
    format: str = "csv"
    schema: Any = None
    header: bool = True
    options: Mapping[str, str] = field(default_factory=dict)
    transformations: tuple[Transform, ...] = ()
    optional: bool = False

    @classmethod
    def from_dict(cls, d: Mapping[str, Any]) -> SourceSpec:
        name = d.get("source_name") or d.get("name")
        if not name:
            raise SpecError(f"source lacks a name: {dict(d)}")
        return cls(
            name=str(name),
            path=d.get("path"),
            format=str(d.get("format", "csv")).lower(),
            schema=d.get("schema") or d.get("readSchema"),
            header=bool(d.get("header", True)),
            options=dict(d.get("options", {})),
            transformations=transforms_from(d.get("transformations")),
            optional=bool(d.get("optional", False)),
        )


@dataclass(frozen=True)
class MeasureSpec:
    """``name := func(column)``; ``func`` in count, count_star, sum, avg, mean,
    min, max, stddev, count_distinct.  ``cast`` is applied to the input before
    aggregating (D2: text marks are summed and compared as numbers), ``out``
    to the result."""

    name: str
    func: str
    column: str | None = None
    cast: str | None = None
    out: str | None = None

    @classmethod
    def from_dict(cls, d: Mapping[str, Any]) -> MeasureSpec:
        return cls(str(d["name"]), str(d["func"]).lower(), d.get("column"),
                   d.get("cast"), d.get("out"))


@dataclass(frozen=True)
class MappingSpec:
    """N sources conformed into one table (LOD-8).

    ``columns`` declares the conformed schema as (name, type) in output order
    (D1, D11, D23).  When empty it is derived: first-seen order over the
    transformed sources, the type common to all.
    """

    sources: tuple[SourceSpec, ...]
    columns: tuple[tuple[str, str], ...] = ()
    keys: tuple[str, ...] = ()
    measures: tuple[MeasureSpec, ...] = ()
    output_path: str | None = None

    @classmethod
    def from_dict(cls, d: Mapping[str, Any]) -> MappingSpec:
        srcs = tuple(SourceSpec.from_dict(s) for s in d.get("data_sources", ()))
        if not srcs:
            raise SpecError("mapping has no data_sources")
        names = [s.name for s in srcs]
        if len(set(names)) != len(names):
            raise SpecError(f"duplicate source names: {names}")
        cols = tuple((str(c["col_name"]), str(c.get("col_type", "string")))
                     for c in d.get("columns", ()))
        return cls(
            sources=srcs,
            columns=cols,
            keys=tuple(d.get("keys", ())),
            measures=tuple(MeasureSpec.from_dict(m) for m in d.get("measures", ())),
            output_path=d.get("output_path"),
        )

    def transformation_columns(self) -> list[str]:
        """Ordered, de-duplicated (ignoring case) column names that any source's
        transformations produce (PRJ-2)."""
        seen: dict[str, str] = {}
        for s in self.sources:
            for t in s.transformations:
                seen.setdefault(t.column_name.lower(), t.column_name)
        return list(seen.values())


class LoadType(enum.Enum):
    FULL = "full"
    INCREMENTAL = "incremental"

    @classmethod
    def parse(cls, value: str | LoadType | None) -> LoadType:
        """``incremental`` or ``full`` (LOD-3).  Unlike the reference, which treats
        every other word as full, unknown values are refused."""
        if isinstance(value, LoadType):
            return value
        v = (value or "").strip().lower()
        for lt in cls:
            if lt.value == v:
                return lt
        raise SpecError(f"unknown load_type {value!r}; use 'full' or 'incremental'")


class SliceMode(enum.Enum):
    """How an incremental job treats its source (D7).

    ``snapshot``: the whole source is stamped with the business date.
    ``slice``: only source rows whose incremental column equals the date are read.
    """

    SNAPSHOT = "snapshot"
    SLICE = "slice"

    @classmethod
    def parse(cls, value: str | SliceMode | None) -> SliceMode:
        if isinstance(value, SliceMode):
            return value
        v = (value or "snapshot").strip().lower()
        for m in cls:
            if m.value == v:
                return m
        raise SpecError(f"unknown slice_mode {value!r}; use 'snapshot' or 'slice'")


@dataclass(frozen=True)
class LoadSpec:
    """Where and how a job writes (LOD-1..3).

    ``target`` is a path (``format`` parquet/csv/json) or a table name for jdbc
    and table (the session catalog).
    """

    target: str
    load_type: LoadType = LoadType.FULL
    incremental_column: str | None = None
    transformations: tuple[Transform, ...] = ()
    format: str = "parquet"
    slice_mode: SliceMode = SliceMode.SNAPSHOT
    partition_by: tuple[str, ...] = ()

    def __post_init__(self):
        if self.load_type is LoadType.INCREMENTAL and not self.incremental_column:
            raise SpecError("incremental load needs incremental_column")
        if not self.partition_by and self.incremental_column:
            # Full and incremental loads of one target must agree on its layout.
            object.__setattr__(self, "partition_by", (self.incremental_column,))
        if self.incremental_column and [c.lower() for c in self.partition_by] != [self.incremental_column.lower()]:
            raise SpecError("a target with incremental_column is partitioned by that column alone")

    @classmethod
    def from_dict(cls, d: Mapping[str, Any]) -> LoadSpec:
        target = d.get("targetTable") or d.get("target")
        if not target:
            raise SpecError(f"load config lacks targetTable: {dict(d)}")
        return cls(
            target=str(target),
            load_type=LoadType.parse(d.get("load_type", "full")),
            incremental_column=d.get("incremental_column"),
            transformations=transforms_from(d.get("transformations")),
            format=str(d.get("format", "parquet")).lower(),
            slice_mode=SliceMode.parse(d.get("slice_mode")),
            partition_by=tuple(d.get("partition_by") or ()),
        )


@dataclass(frozen=True)
class ConnectionProfile:
    """A JDBC endpoint (LOD-7, SRC-9).  The password is read from the environment
    variable ``password_env`` when given; a literal ``password`` is accepted for
    configs shaped like the reference's."""

    url: str
    driver: str | None = None
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    password_env: str | None = None
    name: str | None = None
    extra: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, d: Mapping[str, Any]) -> ConnectionProfile:
        if "url" not in d:
            raise SpecError("connection profile lacks url")
        known = {"url", "driver", "user", "password", "password_env", "connection_name"}
        return cls(url=d["url"], driver=d.get("driver"), user=d.get("user"),
                   password=d.get("password"), password_env=d.get("password_env"),
                   name=d.get("connection_name"),
                   extra={k: str(v) for k, v in d.items() if k not in known})

    def resolved_password(self) -> str | None:
        if self.password_env:
            return os.environ.get(self.password_env)
        return self.password

    def jdbc_options(self) -> dict[str, str]:
        opts = {**self.extra, "url": self.url}
        if self.driver:
            opts["driver"] = self.driver
        if self.user:
            opts["user"] = self.user
        pw = self.resolved_password()
        if pw is not None:
            opts["password"] = pw
        return opts


def profiles_from(d: Mapping[str, Any]) -> dict[str, ConnectionProfile]:
    """``{"source_db_configs": {...}, "target_db_configs": {...}}`` → profiles by
    key; a ``connection_name`` is registered under that name too (SRC-9)."""
    out: dict[str, ConnectionProfile] = {}
    for key, body in d.items():
        p = ConnectionProfile.from_dict(body)
        out[key] = p
        if p.name:
            out[p.name] = p
    return out
