"""String column helpers (STR-1..14, MTH-6, FLT-5).

All are built-in Spark expressions (JVM, whole-stage codegen); no Python runs
per row.  Python-style slicing semantics are spelled out where they differ
from SQL's 1-based ``substring``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim(c: Column | str) -> Column:
    """Strip spaces on both sides (STR-1)."""
    return F.trim(_c(c))


def upper(c: Column | str) -> Column:
    """Upper case (STR-2)."""
    return F.upper(_c(c))


def lstrip_whitespace(c: Column | str) -> Column:
    """Strip all leading whitespace, tabs and newlines too, as Python's
    ``lstrip()`` (STR-3); Spark's ``ltrim`` strips spaces only (D19)."""
    return F.regexp_replace(_c(c), r"^\s+", "")


def count_substring(c: Column | str, sub: str) -> Column:
    """Non-overlapping occurrences of ``sub`` (STR-4), as ``str.count``."""
    if not sub:
        raise ValueError("count_substring needs a non-empty substring")
    s = _c(c)
    return F.floor((F.length(s) - F.length(F.replace(s, F.lit(sub), F.lit(""))))
                   / F.lit(len(sub))).cast("int")


def py_slice(c: Column | str, start: int, stop: int | None = None) -> Column:
    """``s[start:stop]`` for non-negative bounds (STR-5): ``s[3:7]`` is
    ``substring(s, 4, 4)``."""
    if start < 0 or (stop is not None and stop < 0):
        raise ValueError("py_slice takes non-negative bounds")
    s = _c(c)
    if stop is None:
        return F.substring(s, start + 1, 2**31 - 1)
    return F.substring(s, start + 1, max(stop - start, 0))


def chars(c: Column | str) -> Column:
    """The characters of a string as an array (STR-10), as ``list(s)``: no
    empty tail, and the empty string gives an empty array (``split`` alone
    gives ``['']``)."""
    s = _c(c)
    return F.when(F.length(s) == 0, F.array().cast("array<string>")).otherwise(F.split(s, ""))


def py_step(c: Column | str, step: int, start: int = 0, stop: int | None = None) -> Column:
    """``s[start:stop:step]`` (STR-6, STR-7, STR-8).

    Positive step: every ``step``-th character from ``start`` (``s[::2]``,
    ``s[0:10:9]``).  Negative step with default bounds: the same over the
    reversed string (``s[::-2]``).  ``step == 1`` over the whole string is the
    string itself.
    """
    if step == 0:
        raise ValueError("slice step cannot be zero")
    s = _c(c)
    if step < 0:
        if start != 0 or stop is not None:
            raise ValueError("negative steps are supported over the whole string only")
        s, step = F.reverse(s), -step
    if step == 1 and start == 0 and stop is None:
        return s
    hi = stop

    def keep(_x: Column, i: Column) -> Column:
        cond = (i >= start) & (((i - start) % step) == 0)
        return cond & (i < hi) if hi is not None else cond

    return F.concat_ws("", F.filter(F.split(s, ""), keep))


def reverse(c: Column | str) -> Column:
    """Reversed string (STR-9)."""
    return F.reverse(_c(c))


def words(c: Column | str, sep: str = " ") -> Column:
    """Split on a literal separator (STR-11); empty tokens are kept, as
    ``str.split(' ')``."""
    import re
    return F.split(_c(c), re.escape(sep))


def initials(c: Column | str) -> Column:
    """First letter of each word, joined (STR-12)."""
    return F.concat_ws("", F.transform(words(c), lambda w: F.left(w, F.lit(1))))


def upper_chars(c: Column | str) -> Column:
    """Each character upper-cased, joined back (STR-13)."""
    return F.concat_ws("", F.transform(chars(c), F.upper))


def format_pair(a: Column | str, b: Column | str, template: str = "%s is %s") -> Column:
    """``"{a} is {b}"`` / ``"{k} -> {v}"`` (STR-14)."""
    return F.format_string(template, _c(a), _c(b))


def word_length_parity(c: Column | str) -> Column:
    """'even' / 'odd' for the length of each word (MTH-6)."""
    return F.transform(words(c), lambda w: F.when(F.length(w) % 2 == 0, "even").otherwise("odd"))


def words_with_prefix(c: Column | str, prefix: str) -> Column:
    """The words that start with ``prefix`` (FLT-5); an empty token simply does
    not match."""
    return F.filter(words(c), lambda w: w.startswith(prefix))
