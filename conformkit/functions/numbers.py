"""Arithmetic and labelling helpers (AGG-12, MTH-1..5, FLT-4, SRT-4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def add(a: Column | str, b: Column | str) -> Column:
    """``a + b`` (AGG-12)."""
    return _c(a) + _c(b)


def square_if_even(c: Column | str) -> Column:
    """``x ** 2`` for even ``x``, else null (MTH-1)."""
    x = _c(c)
    return F.when(x % 2 == 0, F.pow(x, 2))


def plus_ten_percent(c: Column | str) -> Column:
    """``x + x / 10`` (MTH-2)."""
    x = _c(c)
    return x + x / 10


def _seeded(key: Column | str, seed: int) -> Column:
    """52 bits of md5(key|seed): a hash that other engines have too."""
    text = F.concat(_c(key).cast("string"), F.lit(f"|{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def seeded_int(key: Column | str, seed: int, low: int = 0, high: int = 100) -> Column:
    """A repeatable 'random' integer in [low, high] per key (MTH-3): a hash of
    the key and the seed, so a re-run task (lost executor) yields the same
    value, unlike ``rand()`` whose result depends on partitioning."""
    span = high - low + 1
    return (_seeded(key, seed) % F.lit(span) + F.lit(low)).cast("int")


def seeded_order_key(key: Column | str, seed: int) -> Column:
    """Sort key for a repeatable shuffle of rows (SRT-4)."""
    return _seeded(key, seed)


def compare_label(a: Column | str, b) -> Column:
    """'greater' / 'less' / 'equal' (MTH-4)."""
    x = _c(a)
    y = b if isinstance(b, Column) else F.lit(b)
    return F.when(x > y, "greater").when(x < y, "less").otherwise("equal")


def even_or_odd_label(c: Column | str) -> Column:
    """The value as text when even, else ``'ODD'`` (MTH-5); one string column
    instead of Python's mixed list."""
    x = _c(c)
    return F.when(x % 2 == 0, x.cast("string")).otherwise(F.lit("ODD"))


def divisible_by(c: Column | str, *divisors: int) -> Column:
    """True when divisible by every divisor (FLT-4)."""
    x = _c(c)
    cond = F.lit(True)
    for d in divisors:
        cond = cond & (x % d == 0)
    return cond
