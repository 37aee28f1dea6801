"""Exact and approximate quantiles with bounded memory in every task and on the
driver (AGG-8).

``exact_quantiles`` is one algorithm for any size and distribution.  Every wanted
rank has a bracket [low, high] of values.  Every pass covers all columns and takes,
once per distinct bracket whatever the number of ranks in it, the rows below and
inside it, the rows equal to its ends, and a KLL sketch of the rows inside (the
first pass: of whole columns).  The sketch gives the next bracket by RANK, so a pass shrinks it to
about one hundredth of its rows whatever the values look like; a bracket of at
most half the sketch's size is read off exactly.  The counts are exact, so a sketch
that misses a rank is noticed and its bracket taken again with a wider margin.
A value that holds many rows is met as an end of its bracket and counted.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH = 4096  # a KLL sketch of at most this many values holds all of them
MARGIN = 0.005  # rank margin, several times the error of such a sketch
FAN_IN = 64  # partial sketches that the last task merges


def interpolate(values: dict[int, float], pos: float) -> float:
    """Linear interpolation at fractional 0-based position ``pos``, written as
    Spark's ``percentile`` writes it, so both give the same bits."""
    lower, higher = math.floor(pos), math.ceil(pos)
    if lower == higher:
        return values[lower]
    return (higher - pos) * values[lower] + (pos - lower) * values[higher]


def _value(column: str) -> Column:
    """The column as double; NaN is null (as pandas skips it)."""
    x = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(x), x)


@dataclass
class _Bracket:
    """Where a 0-based rank of a column lies: in [low, high]."""

    column: int
    rank: int
    low: float = -math.inf
    high: float = math.inf
    margin: float = MARGIN
    before: tuple[float, float] = (-math.inf, math.inf)

    @property
    def span(self) -> tuple[int, float, float]:
        return self.column, self.low, self.high


def _whole_columns(df: DataFrame, columns: Sequence[str], spans: list[tuple], k: int) -> dict[int, dict]:
    """Count, ends and sketch of whole columns: one aggregate, one sketch each."""
    partial, final = [], []
    for i, (column, _, _) in enumerate(spans):
        x = _value(columns[column])
        partial += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}"),
                    F.kll_sketch_agg_double(x, k).alias(f"s{i}")]
        final += [F.sum(f"n{i}").alias(f"n{i}"), F.min(f"min{i}").alias(f"min{i}"), F.max(f"max{i}").alias(f"max{i}"),
                  F.kll_merge_agg_double(f"s{i}", k).alias(f"s{i}")]
    row = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(FAN_IN)).alias("__g")).agg(*partial).agg(*final).first()
    return {i: {"below": 0, "n": row[f"n{i}"] or 0, "low": 0, "high": 0, "min": row[f"min{i}"], "max": row[f"max{i}"],
                "next": row[f"min{i}"], "last": row[f"max{i}"], "s": row[f"s{i}"]} for i in range(len(spans))}


def _narrow_spans(df: DataFrame, columns: Sequence[str], spans: list[tuple], k: int) -> dict[int, dict]:
    """Counts, ends and sketch of the rows inside each span.  The rows below the
    spans are plain sums; only the few rows inside one reach the sketches, once
    per span that holds them."""
    below = df.agg(*[F.count_if(_value(columns[c]) < low).alias(f"b{i}") for i, (c, low, _) in enumerate(spans)]).first()
    hits = [F.when((_value(columns[c]) >= low) & (_value(columns[c]) <= high),
                   F.struct(F.lit(i).alias("span"), _value(columns[c]).alias("x"), (_value(columns[c]) == low).alias("low"),
                            (_value(columns[c]) == high).alias("high")))
            for i, (c, low, high) in enumerate(spans)]
    partial = (df.select(F.explode(F.array_compact(F.array(*hits))).alias("h")).select("h.*")
               .groupBy("span", F.pmod(F.spark_partition_id(), F.lit(FAN_IN)).alias("__g"))
               .agg(F.count("x").alias("n"), F.count_if("low").alias("low"), F.count_if("high").alias("high"),
                    F.min(F.when(~F.col("low"), F.col("x"))).alias("next"),
                    F.max(F.when(~F.col("high"), F.col("x"))).alias("last"),
                    F.min("x").alias("min"), F.max("x").alias("max"), F.kll_sketch_agg_double("x", k).alias("s")))
    final = partial.groupBy("span").agg(
        *[F.sum(c).alias(c) for c in ("n", "low", "high")], F.min("next").alias("next"), F.max("last").alias("last"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.kll_merge_agg_double("s", k).alias("s"))
    out = {i: {"below": below[i], "n": 0, "low": 0, "high": 0} for i in range(len(spans))}
    for row in final.collect():  # one row per span
        out[row["span"]].update(row.asDict())
    return out


def _sketched(df: DataFrame, columns: Sequence[str], brackets: list[_Bracket], k: int) -> list[dict]:
    """One pass: the counts and the sketch of every distinct bracket, partial
    sketches merged in two levels so that the last task gets FAN_IN of them, and
    the quantiles that each rank asks of its bracket's sketch."""
    spans = list(dict.fromkeys(b.span for b in brackets))
    whole = all(low == -math.inf and high == math.inf for _, low, high in spans)
    of = dict(zip(spans, (_whole_columns if whole else _narrow_spans)(df, columns, spans, k).values()))
    out = [dict(of[b.span]) for b in brackets]
    # The merged sketches (of a fixed size) are read for each rank and both ends
    # of its margin.
    asked = []
    for i, (b, got) in enumerate(zip(brackets, out)):
        at, n = b.rank - got["below"], max(1, got["n"])
        shares = [min(1.0, max(0.0, (at + 0.5) / n + d)) for d in (0, -b.margin, b.margin)]
        asked.append(F.array(*[F.kll_sketch_get_quantile_double(f"s{spans.index(b.span)}", F.lit(p)) for p in shares])
                     .alias(f"q{i}") if got["n"] else F.lit(None).alias(f"q{i}"))
    sketches = df.sparkSession.createDataFrame([tuple(of[s].get("s") for s in spans)],
                                               ", ".join(f"s{i} binary" for i in range(len(spans))))
    quantiles = sketches.select(*asked).first()
    for i, got in enumerate(out):
        got["q"] = quantiles[i]
    return out


def order_statistics(df: DataFrame, columns: Sequence[str], ranks: Sequence[Sequence[int]],
                     sketch: int = SKETCH) -> list[dict[int, float]]:
    """The values at the 0-based ``ranks[i]`` of ``columns[i]`` (nulls and NaN
    skipped)."""
    found: list[dict[int, float]] = [{} for _ in columns]
    open_ = [_Bracket(c, r) for c in range(len(columns)) for r in sorted(set(ranks[c]))]
    while open_:
        passed = _sketched(df, columns, open_, sketch)
        still = []
        for b, got in zip(open_, passed):
            at = b.rank - got["below"]
            if not 0 <= at < got["n"]:  # the sketch missed it: the bracket before, a wider margin
                (b.low, b.high), b.margin = b.before, b.margin * 4
                still.append(b)
                continue
            # Nearest inner values; an infinite end is a bound or a value.
            if got["min"] == got["max"] or at < got["low"]:
                found[b.column][b.rank] = got["min"]
            elif at >= got["n"] - got["high"]:
                found[b.column][b.rank] = got["max"]
            elif got["n"] <= sketch // 2:
                found[b.column][b.rank] = got["q"][0]
            else:
                inner = (got["next"] if got["low"] else got["min"], got["last"] if got["high"] else got["max"])
                b.before = inner
                b.low, b.high = max(inner[0], got["q"][1]), min(inner[1], got["q"][2])
                still.append(b)
        open_ = still
    return found


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    counts: Sequence[int] | None = None, sketch: int = SKETCH) -> list[list[float | None]]:
    """Exact linearly interpolated quantiles of every column (nulls and NaN
    skipped).  This is an action: each pass is one aggregate over the columns.
    Pass ``counts`` (non-null, non-NaN rows) where they are already known."""
    if counts is None:
        counts = list(df.agg(*[F.count(_value(c)).alias(f"n{i}") for i, c in enumerate(columns)]).first())
    places = [[(n - 1) * p for p in probs] if n else [] for n in counts]
    ranks = [[r for h in pos for r in (math.floor(h), math.ceil(h))] for pos in places]
    values = order_statistics(df, columns, ranks, sketch)
    return [[interpolate(v, h) for h in pos] or [None for _ in probs] for v, pos in zip(values, places)]


def approx_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                     k: int = 2048, fan_in: int = FAN_IN) -> list[list[float | None]]:
    """Approximate quantiles of several columns from mergeable KLL sketches,
    merged in two levels.  Normalized rank error is about 1.65% x 200 / ``k``."""
    group = F.pmod(F.spark_partition_id(), F.lit(fan_in)).alias("__g")
    partial = df.groupBy(group).agg(*[F.kll_sketch_agg_double(_value(c), k).alias(f"s{i}")
                                      for i, c in enumerate(columns)])
    merged = partial.agg(*[F.kll_merge_agg_double(f"s{i}", k).alias(f"s{i}")
                           for i in range(len(columns))])
    row = merged.select(*[
        F.when(F.col(f"s{i}").isNotNull() & (F.kll_sketch_get_n_double(f"s{i}") > 0),
               F.array(*[F.kll_sketch_get_quantile_double(f"s{i}", F.lit(float(p))) for p in probs]))
        .alias(f"q{i}") for i in range(len(columns))]).first()
    return [row[f"q{i}"] for i in range(len(columns))]
