"""Grouped measures, counts and profiles (AGG-1..11).

Every aggregate here is algebraic (count, sum, min, max, avg, stddev) and so
runs as partial aggregate → shuffle on the keys → final aggregate: a key that
holds a third of all rows is collapsed to one row per map task before the
shuffle, so hot keys do not pile up in one reducer.  Exact quartiles
in ``profile`` come from bounded sketches; see ``quantiles``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conformkit.operators.quantiles import approx_quantiles, exact_quantiles
from conformkit.specs import MeasureSpec, SpecError, parse_type

_NUMERIC_FUNCS = {"sum", "avg", "mean", "min", "max", "stddev"}


def _column(df: DataFrame, name: str) -> str:
    """The column that ``name`` means, without regard to case (D9); an exact match
    comes first."""
    if name in df.columns:
        return name
    found = [c for c in df.columns if c.lower() == name.lower()]
    if not found:
        raise SpecError(f"no column {name!r}")
    return found[0]


def _measure(df: DataFrame, m: MeasureSpec, null_sum_as_zero: bool) -> Column:
    func = m.func.lower()
    if func == "count_star" or (func == "count" and m.column in (None, "*")):
        out = F.count(F.lit(1))
    else:
        if not m.column:
            raise SpecError(f"measure {m.name!r}: {func} needs a column")
        source = _column(df, m.column)
        c = F.col(f"`{source}`")
        if m.cast:
            c = c.cast(parse_type(m.cast))
        elif func in _NUMERIC_FUNCS and isinstance(df.schema[source].dataType, T.StringType):
            # D2: text compared as text gives max('100','90','9') = '90'.
            c = c.cast(T.DoubleType())
        if func == "count":
            out = F.count(c)
        elif func == "count_distinct":
            out = F.count_distinct(c)
        elif func == "sum":
            out = F.sum(c)
            if null_sum_as_zero:
                out = F.coalesce(out, F.lit(0))
        elif func in ("avg", "mean"):
            out = F.avg(c)
        elif func == "min":
            out = F.min(c)
        elif func == "max":
            out = F.max(c)
        elif func == "stddev":
            out = F.stddev_samp(c)
        else:
            raise SpecError(f"measure {m.name!r}: unknown function {m.func!r}")
    if m.out:
        out = out.cast(parse_type(m.out))
    return out.alias(m.name)


def summarize(df: DataFrame, keys: Sequence[str], measures: Iterable[MeasureSpec | dict],
              drop_null_keys: bool = False, null_sum_as_zero: bool = False,
              order_by_keys: bool = False) -> DataFrame:
    """``GROUP BY keys`` with configured measures (AGG-1, AGG-4..6).

    Spark keeps null keys and an all-null sum is null.  ``drop_null_keys`` and
    ``null_sum_as_zero`` give pandas' ``groupby`` behaviour (D17);
    ``order_by_keys`` sorts the (small) result by key (SRT-3).
    """
    ms = [m if isinstance(m, MeasureSpec) else MeasureSpec.from_dict(m) for m in measures]
    if not ms:
        raise SpecError("summarize needs at least one measure")
    if drop_null_keys and keys:
        cond = F.lit(True)
        for k in keys:
            source = _column(df, k)
            cond = cond & F.col(f"`{source}`").isNotNull()
            if isinstance(df.schema[source].dataType, (T.FloatType, T.DoubleType)):
                cond = cond & ~F.isnan(F.col(f"`{source}`"))  # pandas drops NaN keys too
        df = df.filter(cond)
    out = df.groupBy(*keys).agg(*[_measure(df, m, null_sum_as_zero) for m in ms])
    return out.orderBy(*keys) if order_by_keys and keys else out


def measure_report(df: DataFrame, keys: Sequence[str],
                   measure_sets: dict[str, Sequence[MeasureSpec]]) -> DataFrame:
    """Several groups of measures over the same keys, as one long table
    (keys…, measure_set, measure, value double) (AGG-3).

    The reference runs one aggregation (and one scan) per group of measures; here
    all measures go into ONE aggregate, so the input is read and shuffled once,
    and the wide row is then unpivoted.
    """
    all_ms = [(s, m) for s, ms in measure_sets.items() for m in ms]
    wide_names = {(s, m.name): f"__m{i}" for i, (s, m) in enumerate(all_ms)}
    aggs = []
    for (s, m) in all_ms:
        c = _measure(df, m, False)
        aggs.append(c.cast("double").alias(wide_names[(s, m.name)]))
    wide = df.groupBy(*keys).agg(*aggs)
    entries = [F.struct(F.lit(s).alias("measure_set"), F.lit(m.name).alias("measure"),
                        F.col(wide_names[(s, m.name)]).alias("value"))
               for (s, m) in all_ms]
    return (wide.select(*keys, F.explode(F.array(*entries)).alias("_e"))
                .select(*keys, "_e.measure_set", "_e.measure", "_e.value"))


def non_null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: the count of non-null values of every column (AGG-7)."""
    cols = list(columns or df.columns)
    return df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in cols])


PROFILE_SCHEMA = ("column string, count bigint, mean double, std double, min double, "
                  "p25 double, p50 double, p75 double, max double")


def profile(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True,
            accuracy: int = 2048, digits: int | None = None) -> DataFrame:
    """pandas ``describe`` for numeric columns (AGG-8, D18), one row per column:
    column, count, mean, std, min, p25, p50, p75, max.  NaN counts as missing,
    as in pandas.  This is an action (it runs its aggregates now) and returns
    a small frame of the results.

    Count, mean, std, min and max are one aggregate over all columns.  Quartiles
    are exact, interpolated as pandas / ``quantile_cont`` (``quantiles.exact_quantiles``:
    one job per pass for all columns, the same at every size).

    ``exact=False`` takes approximate quartiles from mergeable KLL sketches
    (``quantiles.approx_quantiles``, sketch size ``accuracy``), merged in two
    levels so no task receives one sketch per map task.  ``digits`` rounds mean and std for reading: both are
    floating-point sums whose last bits depend on the order rows are added in
    (partitioning, engine).
    """
    if columns is None:
        columns = [f.name for f in df.schema.fields
                   if isinstance(f.dataType, T.NumericType)]
    if not columns:
        raise SpecError("profile: no numeric columns")
    probs = [0.25, 0.5, 0.75]

    def val(c: str) -> Column:
        x = F.col(f"`{c}`").cast("double")
        return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)

    aggs = []
    for i, c in enumerate(columns):
        x = val(c)
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"),
                 F.stddev_samp(x).alias(f"std{i}"), F.min(x).alias(f"min{i}"),
                 F.max(x).alias(f"max{i}")]
    stats = df.agg(*aggs).first()

    if exact:
        quartiles = exact_quantiles(df, columns, probs, [stats[f"n{i}"] for i in range(len(columns))])
    else:
        quartiles = approx_quantiles(df, columns, probs, k=accuracy)

    def rnd(v):
        return None if v is None or digits is None else round_half_up(v, digits)

    rows = []
    for i, c in enumerate(columns):
        q = quartiles[i] or [None, None, None]
        mean, std = stats[f"mean{i}"], stats[f"std{i}"]
        if digits is not None:
            mean, std = rnd(mean), rnd(std)
        rows.append((c, stats[f"n{i}"], mean, std, stats[f"min{i}"], q[0], q[1], q[2],
                     stats[f"max{i}"]))
    return df.sparkSession.createDataFrame(rows, PROFILE_SCHEMA)


def round_half_up(v: float, digits: int) -> float:
    """Round as Spark's ``round`` does: HALF_UP on the double's shortest
    decimal form."""
    from decimal import ROUND_HALF_UP, Decimal
    return float(Decimal(repr(v)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def global_range(df: DataFrame, column: str) -> DataFrame:
    """Global min and max of one column (AGG-9)."""
    c = F.col(column)
    return df.agg(F.min(c).alias("min_value"), F.max(c).alias("max_value"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column (AGG-10): map-side de-duplication, then one
    shuffle on the value."""
    return df.select(column).distinct()


def count_value(df: DataFrame, column: str, value) -> DataFrame:
    """How many rows hold ``value`` in ``column`` (AGG-11)."""
    return df.agg(F.count_if(F.col(column) == F.lit(value)).alias("n_matching"))
