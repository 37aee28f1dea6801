"""Nested values aligned by field name (PRJ-3, PRJ-4, below the top level).

Spark casts a struct to another by position: (a, b) read as (b, a) swaps the
values.  Here the source and target types are walked together on the driver and
turned into ``struct``, ``transform`` and map expressions that pick every field
by name, without regard to case.  All of it stays inside one projection.

* a struct's fields the target lacks are dropped, fields the source lacks are
  typed nulls; a null struct stays null;
* array elements and map values follow the same rules; map keys are cast;
* with ``safe`` a leaf that does not cast is null, and so is a map whose keys do
  not all cast to different values (a map cannot hold them).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conformkit.specs import SpecError

NESTED = (T.StructType, T.ArrayType, T.MapType)


class ConformError(SpecError):
    """A transformation or alignment that Spark cannot plan, with its context."""


def same_type(a: T.DataType, b: T.DataType) -> bool:
    """Equal but for nullability."""
    return a.simpleString() == b.simpleString()


def find_field(struct: T.StructType, name: str, path: str) -> T.StructField | None:
    """The field that ``name`` means, without regard to case."""
    hits = [f for f in struct.fields if f.name.lower() == name.lower()]
    if len(hits) > 1:
        raise ConformError(f"column {path!r}: field {name!r} is ambiguous (case): {[f.name for f in hits]}")
    return hits[0] if hits else None


def _check_kinds(src: T.DataType, dst: T.DataType, path: str) -> None:
    """Nested values become nested values of the same kind, or text."""
    if isinstance(dst, NESTED) and type(src) is not type(dst) and not isinstance(src, T.NullType) \
            or isinstance(src, NESTED) and not isinstance(dst, (*NESTED, T.StringType)):
        raise ConformError(f"column {path!r}: {src.simpleString()} does not become {dst.simpleString()}")


def aligned(c: Column, src: T.DataType, dst: T.DataType, path: str, safe: bool = False) -> Column:
    """``c`` of type ``src`` as type ``dst``; ``path`` names it in errors."""
    _check_kinds(src, dst, path)
    if same_type(src, dst):
        return c
    if isinstance(src, T.NullType):
        return F.lit(None).cast(dst)
    if isinstance(dst, T.StructType):
        fields = []
        for f in dst.fields:
            found = find_field(src, f.name, path)
            value = (F.lit(None).cast(f.dataType) if found is None else
                     aligned(c.getField(found.name), found.dataType, f.dataType, f"{path}.{f.name}", safe))
            fields.append(value.alias(f.name))
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(dst, T.ArrayType):
        return F.transform(c, lambda x: aligned(x, src.elementType, dst.elementType, f"{path}[]", safe))
    if isinstance(dst, T.MapType):
        if same_type(src.keyType, dst.keyType):
            return F.transform_values(c, lambda _, v: aligned(v, src.valueType, dst.valueType, f"{path}{{}}", safe))
        entries = F.transform(F.map_entries(c), lambda e: F.struct(
            aligned(e["key"], src.keyType, dst.keyType, f"{path}{{key}}", safe).alias("key"),
            aligned(e["value"], src.valueType, dst.valueType, f"{path}{{}}", safe).alias("value")))
        if safe:
            entries = F.when(~_keys_collide(c, src, dst, path), entries)
        return F.map_from_entries(entries)
    return c.try_cast(dst) if safe else c.cast(dst)


def _keys_collide(c: Column, src: T.MapType, dst: T.MapType, path: str) -> Column:
    """Whether some keys do not cast, or cast to the same value."""
    cast = F.transform(F.map_keys(c), lambda k: aligned(k, src.keyType, dst.keyType, f"{path}{{key}}", True))
    return F.size(F.array_distinct(F.array_compact(cast))) < F.size(c)


def failures(c: Column, src: T.DataType, dst: T.DataType, path: str) -> list[tuple[str, Column]]:
    """(path, condition) of every leaf below ``c`` that may not cast.  Paths name
    struct fields with ``.``, array elements with ``[]``, map values with ``{}``
    and map keys with ``{key}``."""
    if same_type(src, dst) or isinstance(src, T.NullType):
        return []
    _check_kinds(src, dst, path)
    if isinstance(dst, T.StructType):
        out = []
        for f in dst.fields:
            found = find_field(src, f.name, path)
            if found is not None:
                out += failures(c.getField(found.name), found.dataType, f.dataType, f"{path}.{f.name}")
        return out
    if isinstance(dst, T.ArrayType):
        return _inside(c, src.elementType, dst.elementType, f"{path}[]")
    if isinstance(dst, T.MapType):
        out = _inside(F.map_values(c), src.valueType, dst.valueType, f"{path}{{}}")
        if not same_type(src.keyType, dst.keyType):
            out.append((f"{path}{{key}}", F.coalesce(_keys_collide(c, src, dst, path), F.lit(False))))
        return out
    return [(path, c.isNotNull() & c.try_cast(dst).isNull())]


def _inside(c: Column, src: T.DataType, dst: T.DataType, path: str) -> list[tuple[str, Column]]:
    """The failures of an array's elements, each as a condition on the array."""
    def any_of(i: int) -> Callable[[Column], Column]:
        return lambda x: F.coalesce(failures(x, src, dst, path)[i][1], F.lit(False))

    names = [name for name, _ in failures(F.lit(None), src, dst, path)]
    return [(name, F.coalesce(F.exists(c, any_of(i)), F.lit(False))) for i, name in enumerate(names)]


def merged_type(a: T.DataType, b: T.DataType, path: str,
                leaf: Callable[[str, T.DataType, T.DataType], T.DataType]) -> T.DataType:
    """A type that holds the values of both: structs by field name in first-seen
    order, arrays and maps by what they hold, leaves as ``leaf`` says."""
    if same_type(a, b) or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        fields = {}
        for f in [*a.fields, *b.fields]:
            at = f.name.lower()
            if at in fields:
                first = fields[at]
                fields[at] = T.StructField(first.name, merged_type(first.dataType, f.dataType, f"{path}.{first.name}", leaf))
            else:
                fields[at] = T.StructField(f.name, f.dataType)
        return T.StructType(list(fields.values()))
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merged_type(a.elementType, b.elementType, f"{path}[]", leaf))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(merged_type(a.keyType, b.keyType, f"{path}{{key}}", leaf),
                         merged_type(a.valueType, b.valueType, f"{path}{{}}", leaf))
    return leaf(path, a, b)
