"""Map and JSON column helpers (MAP-1..4, JSN-1).

JSON whose shape drifts from row to row (a number here, a text, list or object
there) is parsed once into Spark's ``VARIANT`` and read by path with a type; only
what does not fit becomes null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_json_map(c: Column | str, value_type: str = "int") -> Column:
    """JSON object text → ``map<string, value_type>`` (JSN-1).  Malformed text
    gives null rather than failing the job."""
    return F.from_json(_c(c), f"map<string,{value_type}>")


def keys(m: Column | str) -> Column:
    """``d.keys()`` (MAP-1)."""
    return F.map_keys(_c(m))


def values(m: Column | str) -> Column:
    """``d.values()`` (MAP-1)."""
    return F.map_values(_c(m))


def items(m: Column | str) -> Column:
    """``d.items()`` as an array of (key, value) structs (MAP-1); ``explode`` it
    for one row per entry."""
    return F.map_entries(_c(m))


def put(m: Column | str, key: str, value) -> Column:
    """``d[key] = value`` (MAP-2): replaces an existing key instead of failing
    on a duplicate key."""
    mm = _c(m)
    v = value if isinstance(value, Column) else F.lit(value)
    kept = F.map_filter(mm, lambda k, _v: k != F.lit(key))
    return F.map_concat(kept, F.create_map(F.lit(key), v))


def lookup(m: Column | str, key) -> Column:
    """``d.get(key)`` (MAP-3): missing key → null."""
    k = key if isinstance(key, Column) else F.lit(key)
    return F.try_element_at(_c(m), k)


def json_path(c: Column | str, path: str) -> Column:
    """A nested value out of JSON text by path, e.g. ``$.k3[0].contact``
    (MAP-4); for a parsed struct use ``col("k3")[0]["contact"]``."""
    return F.get_json_object(_c(c), path)


def parse_variant(c: Column | str) -> Column:
    """JSON text → ``VARIANT``, each value with the type it has (JSN-1); malformed
    text gives null rather than failing the job."""
    return F.try_parse_json(_c(c))


def variant_get(v: Column | str, path: str, type_name: str = "string") -> Column:
    """The value at ``path`` as ``type_name`` (MAP-4): null where the path is
    missing or holds a value that does not cast to it."""
    return F.try_variant_get(_c(v), path, type_name)


def variant_kind(v: Column | str, path: str = "$") -> Column:
    """The type of the value at ``path`` in this row, such as ``BIGINT`` or
    ``ARRAY<VOID>`` (``VOID``: a JSON null); null where the path is missing."""
    return F.schema_of_variant(F.try_variant_get(_c(v), path, "variant"))


def variant_schema(df: DataFrame, v: str) -> str:
    """The one schema that holds every value of a variant column, its fields by name
    with the common type (``VARIANT`` where types clash): one aggregate, whose
    partial results are schemas, not rows."""
    return df.agg(F.schema_of_variant_agg(_c(v)).alias("s")).first()["s"]


def json_faults(df: DataFrame, c: str, by: str) -> DataFrame:
    """by, n_rows, n_absent, n_malformed of a JSON text column, per value of ``by``."""
    text = _c(c)
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(text.isNull()).alias("n_absent"),
                              F.count_if(text.isNotNull() & parse_variant(text).isNull()).alias("n_malformed"))
