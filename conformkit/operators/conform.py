"""Conform sources to one schema, union them, align to a target (PRJ-1..5, SET-1).

All of these are Project / Union nodes: no shuffle.  A chain of N
transformations collapses into one Project in the optimized plan.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conformkit.operators.nested import ConformError, aligned, failures, merged_type, same_type
from conformkit.specs import Transform, parse_type


def check_case_unique(df: DataFrame, source: str = "input") -> DataFrame:
    """Refuse inputs whose column names collide when case is ignored (D9):
    such a frame makes every later reference ambiguous."""
    low = [c.lower() for c in df.columns]
    dupes = sorted({c for c in df.columns if low.count(c.lower()) > 1})
    if dupes:
        raise ConformError(f"{source}: columns differ only by case: {dupes}")
    return df


def _mentions(expression: str, names: Iterable[str]) -> bool:
    """Whether ``expression`` may refer to any of ``names`` (or to every
    column, via ``*``).  Textual and conservative: a false alarm only splits a
    batch."""
    if re.search(r"(^|[(,.])\s*\*", expression):  # `*`, `f(*)`, `t.*`: every column
        return True
    low = expression.lower()
    return any(re.search(rf"(?<![\w$]){re.escape(n.lower())}(?![\w$])", low) for n in names)


def _batches(transforms: list[Transform]) -> list[list[Transform]]:
    """Split the ordered transformations into runs that can be applied at once:
    no transformation in a run reads or redefines a column set earlier in the
    same run."""
    runs: list[list[Transform]] = []
    current: list[Transform] = []
    defined: set[str] = set()
    for t in transforms:
        name = t.column_name.lower()
        if current and (name in defined or _mentions(t.expression, defined)):
            runs.append(current)
            current, defined = [], set()
        current.append(t)
        defined.add(name)
    if current:
        runs.append(current)
    return runs


def _apply_one(df: DataFrame, t: Transform, source: str) -> DataFrame:
    try:
        return df.withColumn(t.column_name, F.expr(t.expression))
    except (ParseException, AnalysisException) as e:
        raise ConformError(
            f"source {source!r}, column {t.column_name!r}: cannot apply "
            f"{t.expression!r}: {e}") from e


def apply_transformations(df: DataFrame, transforms: Iterable[Transform | dict],
                          source: str = "input") -> DataFrame:
    """Apply ``column_name := expression`` in order (PRJ-1).

    Later expressions see earlier results, a repeated name is applied again and
    the last wins (D10).  ``column_name`` wins over an alias inside the
    expression (D8).  An existing column is matched without case, keeps its
    position and takes the new spelling (D9).

    Independent neighbours are applied together with one ``withColumns`` (one
    analysis, one Project) instead of one ``withColumn`` each, so configs with
    hundreds of columns do not build hundreds of nested projections.
    """
    ts = [t if isinstance(t, Transform) else Transform.from_dict(t) for t in transforms]
    for run in _batches(ts):
        if len(run) == 1:
            df = _apply_one(df, run[0], source)
            continue
        try:
            df = df.withColumns({t.column_name: F.expr(t.expression) for t in run})
        except (ParseException, AnalysisException):
            for t in run:  # replay one by one to name the failing column
                df = _apply_one(df, t, source)
    return df


def _find(df: DataFrame, name: str) -> str | None:
    hits = [c for c in df.columns if c.lower() == name.lower()]
    if len(hits) > 1:
        raise ConformError(f"column {name!r} is ambiguous (case): {hits}")
    return hits[0] if hits else None


def conformed_schema(frames: Sequence[DataFrame],
                     declared: Iterable[tuple[str, str | T.DataType]] = ()) -> T.StructType:
    """The one schema all sources are projected to.

    Declared (name, type) pairs win; otherwise names in first-seen order over
    the frames (D1, D23), each with a type that holds every source's values:
    untyped nulls give way to any type, text and another simple type give text,
    the rest widen as Spark widens them; structs, arrays and maps are merged by
    what they hold, struct fields by name.  Types without a common one (a boolean
    and a number, say) are refused here, before any job runs.
    """
    declared = list(declared)
    if declared:
        return T.StructType([T.StructField(n, parse_type(t), True) for n, t in declared])
    fields: dict[str, T.StructField] = {}
    for df in frames:
        for f in df.schema.fields:
            first = fields.get(f.name.lower())
            name = first.name if first else f.name
            if first:
                typ = merged_type(first.dataType, f.dataType, name, lambda path, a, b: _common_type(df, path, a, b))
            else:
                typ = f.dataType
            fields[name.lower()] = T.StructField(name, typ, True)
    return T.StructType(list(fields.values()))


def _common_type(df: DataFrame, name: str, a: T.DataType, b: T.DataType) -> T.DataType:
    """The common type of two leaves."""
    nested = (T.ArrayType, T.MapType, T.StructType, T.BinaryType)
    if isinstance(a, T.StringType) or isinstance(b, T.StringType):
        if not isinstance(a, nested) and not isinstance(b, nested):
            return T.StringType()
    else:
        try:
            both = F.coalesce(F.lit(None).cast(a), F.lit(None).cast(b))
            return df.sparkSession.range(0).select(both).schema[0].dataType
        except AnalysisException:
            pass
    raise ConformError(f"column {name!r}: no common type of {a.simpleString()} and {b.simpleString()}")


def conform_to(df: DataFrame, schema: T.StructType, source: str = "input",
               safe_cast: bool = False) -> DataFrame:
    """Project ``df`` to exactly ``schema``: matched columns cast to the declared
    type, missing ones as typed nulls (PRJ-3, PRJ-15, D11), extras dropped; the
    fields of structs, also in arrays and maps, by the same rules."""
    cols: list[Column] = []
    for f in schema.fields:
        src = _find(df, f.name)
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            try:
                c = aligned(F.col(f"`{src}`"), df.schema[src].dataType, f.dataType, f.name, safe_cast)
            except ConformError as e:
                raise ConformError(f"source {source!r}, {e}") from None
            cols.append(c.alias(f.name))
    return df.select(*cols)


def union_conformed(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL of frames that share one column list, matched by name (SET-1).

    No empty seed: the seed would stay in the plan as an extra scan.
    """
    if not frames:
        raise ConformError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b), frames)


def conform_and_union(frames: Sequence[tuple[str, DataFrame]],
                      declared: Iterable[tuple[str, str]] = (),
                      safe_cast: bool = False) -> DataFrame:
    """Conform each named frame to one schema, then union (PRJ-2, PRJ-3, SET-1)."""
    schema = conformed_schema([df for _, df in frames], declared)
    return union_conformed([conform_to(df, schema, name, safe_cast) for name, df in frames])


def align_to_target(df: DataFrame, target: T.StructType | DataFrame,
                    safe_cast: bool = False) -> DataFrame:
    """Align rows to a target schema (PRJ-4): target order, names and types, at
    every level of nesting (``operators.nested``).

    Columns match without case; a matched column is cast to the target type
    (D4; ``safe_cast`` uses ``try_cast`` so a bad value becomes null instead of
    failing the job); a target column the source lacks is a typed null.
    Source columns the target lacks are dropped (D3).
    """
    schema = target.schema if isinstance(target, DataFrame) else target
    return conform_to(df, schema, "source", safe_cast)


def cast_rejects(df: DataFrame, target: T.StructType | DataFrame) -> DataFrame:
    """Rows of ``df`` holding a value that does not cast to the target type,
    with a ``rejected_columns`` list (nested values by path, such as
    ``items[].qty``).  Count it to report rejects."""
    schema = target.schema if isinstance(target, DataFrame) else target
    checks = []
    for f in schema.fields:
        src = _find(df, f.name)
        if src is None or same_type(df.schema[src].dataType, f.dataType):
            continue
        checks += [F.when(bad, F.lit(path)) for path, bad in
                   failures(F.col(f"`{src}`"), df.schema[src].dataType, f.dataType, f.name)]
    if not checks:
        return df.limit(0).withColumn("rejected_columns", F.array().cast("array<string>"))
    bad = F.filter(F.array(*checks), lambda x: x.isNotNull())
    return df.withColumn("rejected_columns", bad).filter(F.size("rejected_columns") > 0)
