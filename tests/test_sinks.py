"""Sinks and small session helpers."""

from __future__ import annotations

import glob
import json

from pyspark import StorageLevel
from pyspark.sql import functions as F

from conformkit.session import persisted
from conformkit.sinks import files as SNK
from conformkit.sources import files as SRC


def test_json_documents_are_valid_arrays_across_batches_and_empty_tasks(spark, tmp_path):
    # 25,000 rows over 3 tasks spans several Arrow batches per task; the extra
    # empty partitions must still produce valid (empty) documents.
    df = (spark.range(25000).select(F.col("id"), (F.col("id") * 2).alias("twice"),
                                    F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))
          .repartition(3).union(spark.range(0).select(F.col("id"), F.col("id").alias("twice"),
                                                      F.lit("x").alias("name"))))
    path = str(tmp_path / "docs")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    try:
        SNK.write_json_documents(df, path)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    total = 0
    for f in glob.glob(f"{path}/part-*"):
        with open(f) as fh:
            doc = json.load(fh)  # each file is ONE JSON array
        assert isinstance(doc, list)
        total += len(doc)
    assert total == 25000
    back = SRC.read_json_documents(spark, path, df.schema, mode="FAILFAST")
    assert back.count() == 25000
    assert back.agg(F.sum("twice")).first()[0] == 2 * sum(range(25000))


def test_text_and_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 1), ('q"uote', 2), ("line", None)], "s string, n int")
    SNK.write_csv(df, str(tmp_path / "c"))
    back = SRC.read_csv_typed(spark, str(tmp_path / "c"), "s string, n int")
    assert sorted(back.collect(), key=lambda r: r.s) == sorted(df.collect(), key=lambda r: r.s)
    SNK.write_text(df, str(tmp_path / "t"), "s")
    assert sorted(r.value for r in SRC.read_text_lines(spark, str(tmp_path / "t")).collect()) == \
        sorted(["a,b", 'q"uote', "line"])


def test_preview_is_ordered_and_bounded(spark):
    df = spark.range(100).select((F.col("id") * 7 % 100).alias("v"))
    assert [r.v for r in SNK.preview(df, 3, ["v"]).collect()] == [0, 1, 2]


def test_persisted_releases_the_cache(spark):
    df = spark.range(10).select((F.col("id") + 1).alias("x"))
    with persisted(df) as d:
        assert d.storageLevel == StorageLevel.MEMORY_AND_DISK
        assert d.count() == 10 and d.agg(F.sum("x")).first()[0] == 55
    assert df.storageLevel == StorageLevel.NONE


def test_source_options_reach_every_reader(spark, tmp_path):
    from conformkit.specs import SourceSpec
    spark.range(3).write.parquet(str(tmp_path / "root" / "a"))
    spark.range(3, 5).write.parquet(str(tmp_path / "root" / "deeper" / "b"))
    spec = SourceSpec("nested", str(tmp_path / "root"), "parquet",
                      options={"recursiveFileLookup": "true"})
    assert SRC.read_source(spark, spec).count() == 5
