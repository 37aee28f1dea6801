"""Sorting, top rows and repeatable shuffles (SRT-1..4).

``top_rows`` plans as TakeOrderedAndProject: each task keeps its own top n,
only n rows per task reach the final merge.  ``sort_rows`` is a global sort:
a range-partitioned shuffle, so no single task sorts everything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conformkit.functions.numbers import seeded_order_key


def top_rows(df: DataFrame, n: int, order_by: Sequence[Column | str]) -> DataFrame:
    """First ``n`` rows by a total order (SRT-1); the keys make it stable."""
    if not order_by:
        raise ValueError("top_rows needs an order so the answer is stable")
    return df.orderBy(*order_by).limit(n)


def sort_rows(df: DataFrame, order_by: Sequence[Column | str], split_ties: bool = True) -> DataFrame:
    """Sort (SRT-2).

    A global sort range-partitions on its keys, and equal keys cannot be split
    across ranges: a key value holding a third of the rows would land in one
    task.  ``split_ties`` adds a hash of the whole row as the last key, so
    rows tied on the requested keys spread over several ranges; the order the
    caller asked for is unchanged (ties have no defined order anyway).
    """
    keys = list(order_by)
    if split_ties:
        # A map has no hash; the other columns split the ties.
        hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
        if hashed:
            keys.append(F.xxhash64(*hashed))
    return df.orderBy(*keys)


def seeded_order(df: DataFrame, key: str, seed: int, name: str | None = None) -> DataFrame:
    """A shuffled but repeatable row order (SRT-4): sorted by a hash of the key
    and the seed, ties (rows sharing a key) by a hash of the whole row, so a
    hot key also spreads over several sort ranges.  With ``name`` the hash stays
    as a column of that name; it is taken once."""
    if name is None:
        return sort_rows(df, [seeded_order_key(key, seed), key])
    return sort_rows(df.withColumn(name, seeded_order_key(key, seed)), [name, key])
