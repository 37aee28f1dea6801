"""Row numbers and pairs by position over tables."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conformkit.operators import positions as P
from conformkit.specs import SpecError


@pytest.mark.parametrize("broadcast_files", [P.BROADCAST_FILES, 0])
def test_numbers_are_gapless_and_in_order(spark, broadcast_files):
    rng = random.Random(4)
    values = [rng.choice([7, None, rng.randrange(10_000)]) for _ in range(5_000)]  # a hot value, and nulls
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v int").repartition(7)
    got = P.number_rows(df, [F.col("v").desc_nulls_last(), "id"], broadcast_files=broadcast_files).collect()
    want = sorted(range(len(values)), key=lambda i: (values[i] is None, -(values[i] or 0), i))
    assert [r.id for r in sorted(got, key=lambda r: r.pos)] == want
    assert sorted(r.pos for r in got) == list(range(len(values)))


def test_files_cut_by_spark_are_numbered_in_order(spark):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 100)
    try:
        got = P.number_rows(spark.range(0, 2_500, numPartitions=3), name="n", start=1).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert [r.id + 1 for r in got] == [r.n for r in got] and len(got) == 2_500


def test_numbering_needs_no_one_task_window(spark):
    plan = P.number_rows(spark.range(1000), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_pairs_stop_at_the_shortest(spark):
    a = spark.createDataFrame([(i,) for i in range(50)], "a int").repartition(4)
    b = spark.createDataFrame([(i, "x") for i in range(30)], "b int, t string").repartition(3)
    c = spark.createDataFrame([(i,) for i in range(40)], "c int").repartition(2)
    got = P.pair_by_position([(a, ["a"]), (b, [F.col("b").desc()]), (c, ["c"])]).collect()
    assert sorted((r.pos, r.a, r.b, r.c) for r in got) == [(i, i, 29 - i, i) for i in range(30)]
    assert P.pair_by_position([(a, ["a"]), (b.limit(0), ["b"])]).count() == 0


def test_first_position_and_refusals(spark):
    df = spark.createDataFrame([("q",), ("r",), ("q",)], "v string")
    numbered = P.number_rows(df, ["v"])
    assert P.first_position(numbered, F.col("v") == "r").first().first_pos == 2
    assert P.first_position(numbered, F.col("v") == "z").first().first_pos is None
    with pytest.raises(SpecError):
        P.number_rows(df, name="V")
    with pytest.raises(SpecError):
        P.pair_by_position([(df, []), (df, [])])
