"""Array column helpers (ARR-1..6, SET-3, SET-4, WIN-2, FLT-6, FLT-7, AGG-9/10
in a row).  Python list idioms re-expressed as Spark higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def py_range(start, stop, step=1) -> Column:
    """``range(start, stop, step)`` as an array (ARR-1): the stop is exclusive,
    an empty range is an empty array (``sequence`` alone is inclusive and
    refuses a wrong direction)."""
    if isinstance(step, int) and step == 0:
        raise ValueError("range step cannot be zero")
    a, b, s = _lit(start), _lit(stop), _lit(step)
    nonempty = F.when(s > 0, a < b).otherwise(a > b)
    last = b - F.signum(s).cast("int")
    return F.when(nonempty, F.sequence(a, last, s)).otherwise(F.array().cast("array<int>"))


def item(arr: Column | str, i: int | Column) -> Column:
    """``lst[i]``, negative indices from the end (ARR-2); out of range → null."""
    if isinstance(i, int):
        return F.try_element_at(_c(arr), F.lit(i + 1 if i >= 0 else i))
    return F.try_element_at(_c(arr), F.when(i >= 0, i + 1).otherwise(i))


def append(arr: Column | str, v) -> Column:
    """``lst.append(v)`` (ARR-3)."""
    return F.array_append(_c(arr), _lit(v))


def replace_tail(arr: Column | str, keep: int, new: Column) -> Column:
    """``lst[keep:] = new`` (ARR-4)."""
    return F.concat(F.slice(_c(arr), 1, keep), new)


def set_add(arr: Column | str, v) -> Column:
    """``s.add(v)`` on an array used as a set (ARR-5)."""
    return F.array_union(F.array_distinct(_c(arr)), F.array(_lit(v)))


def map_each(arr: Column | str, f) -> Column:
    """``list(map(f, lst))`` (ARR-6)."""
    return F.transform(_c(arr), f)


def concat(*arrs: Column | str) -> Column:
    """``a + b`` on lists (SET-3)."""
    return F.concat(*[_c(a) for a in arrs])


def repeat(arr: Column | str, n: int | Column) -> Column:
    """``lst * n`` (SET-4)."""
    return F.flatten(F.array_repeat(_c(arr), _lit(n)))


def index_of(arr: Column | str, v) -> Column:
    """``lst.index(v)`` from 0 (WIN-2); absent → null instead of an error."""
    return F.nullif(F.array_position(_c(arr), _lit(v)), F.lit(0)).cast("int") - 1


def without(arr: Column | str, v) -> Column:
    """Skip elements equal to ``v`` (``continue``, FLT-6)."""
    val = _lit(v)
    return F.filter(_c(arr), lambda x: x != val)


def take_until(arr: Column | str, v) -> Column:
    """Elements before the first ``v`` (``break``, FLT-7); the whole array when
    ``v`` is absent."""
    a = _c(arr)
    pos = F.array_position(a, _lit(v))
    return F.when(pos > 0, F.slice(a, F.lit(1), (pos - 1).cast("int"))).otherwise(a)


def distinct(arr: Column | str) -> Column:
    """``set(lst)`` keeping first-seen order (AGG-10 in a row)."""
    return F.array_distinct(_c(arr))


def smallest(arr: Column | str) -> Column:
    """``min(lst)`` (AGG-9 in a row)."""
    return F.array_min(_c(arr))


def largest(arr: Column | str) -> Column:
    """``max(lst)`` (AGG-9 in a row)."""
    return F.array_max(_c(arr))


def joined(arr: Column | str, sep: str = "") -> Column:
    """Join string elements (``''.join(lst)``)."""
    return F.concat_ws(sep, _c(arr))
