"""Exact quantiles: one algorithm at every size, checked against a plain sort."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conformkit.operators import quantiles as Q
from conformkit.operators import summarize as S

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def brute(values, probs):
    xs = sorted(v for v in values if v is not None and not math.isnan(v))
    return [Q.interpolate(dict(enumerate(xs)), (len(xs) - 1) * p) for p in probs]


def frame(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double").repartition(5)


@pytest.mark.parametrize("sketch", [8, 64, 4096])
def test_matches_a_sort(spark, sketch):
    rng = np.random.default_rng(sketch)
    values = [*rng.lognormal(0, 3, 900), *[7.5] * 500, *[-1.0] * 40, None, float("nan"), math.inf, -math.inf, 0.0]
    assert Q.exact_quantiles(frame(spark, values), ["x"], PROBS, sketch=sketch) == [brute(values, PROBS)]


def test_few_values_and_close_values(spark):
    assert Q.exact_quantiles(frame(spark, [7.5] * 300), ["x"], PROBS, sketch=8) == [[7.5] * len(PROBS)]
    close = [1.0, 1.0000000000000002] * 300
    assert Q.exact_quantiles(frame(spark, close), ["x"], PROBS, sketch=8) == [brute(close, PROBS)]


def test_empty_and_several_columns(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("a b"), F.lit(None).cast("double").alias("n"),
                                  (F.col("id") % 3).alias("m"))
    assert Q.exact_quantiles(df, ["a b", "n", "m"], [0.5]) == [[499.5], [None], [1.0]]


def test_log_uniform_values_need_few_passes(spark, monkeypatch):
    df = spark.range(0, 400_000, numPartitions=8).select(F.exp(F.rand(3) * 1400 - 700).alias("x")).persist()
    passes, real = [], Q._sketched
    monkeypatch.setattr(Q, "_sketched", lambda *a: passes.append(1) or real(*a))
    got = Q.exact_quantiles(df, ["x"], [0.25, 0.5, 0.75])[0]
    want = df.agg(F.percentile("x", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))).first()[0]
    df.unpersist()
    assert got == want and len(passes) <= 5


def test_profile_of_a_skewed_column(spark):
    values = [float(i % 1000) for i in range(20_000)] + [5.0] * 9_990 + [math.nan, None]
    df = frame(spark, values)
    row = S.profile(df, ["x"]).first()
    assert row["count"] == 29_990 and [row.p25, row.p50, row.p75] == brute(values, [0.25, 0.5, 0.75])


def test_approx_quantiles_are_close_and_merge_in_two_levels(spark):
    df = spark.range(0, 100_000, numPartitions=16).selectExpr("cast(id as double) as x", "cast(id % 7 as double) as y")
    qx, qy = Q.approx_quantiles(df, ["x", "y"], [0.25, 0.5, 0.75])
    for got, want in zip(qx, [25_000, 50_000, 75_000]):
        assert abs(got - want) <= 0.01 * 100_000
    assert qy == [1.0, 3.0, 5.0]
    assert Q.approx_quantiles(spark.createDataFrame([(None,)], "x double"), ["x"], [0.5]) == [None]
