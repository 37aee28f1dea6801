"""Free text through CSV and text files, JSON documents by size, JDBC read options."""

from __future__ import annotations

import glob
import json

import pytest
from pyspark.sql import functions as F

from conformkit.sinks import files as SNK
from conformkit.sources import files as SRC
from conformkit.sources import jdbc as JSRC
from conformkit.specs import SourceSpec, SpecError

TEXTS = ["plain", "", None, " ", "  two blanks  ", "\t tab \t", "a\nb", "a\r\nb\r", "\n", '"', '""', 'say "hi", he', "a,b", ",",
         "back\\slash\\", '\\"', "\\n", "'", "#note", "null", "NULL", "\\N", "é\U0001f600\u2028x", "x" * 50_000 + "\n" + "y",
         "\x01", "-", "1", "true", '"quoted"', 'end"', '\n"\n', "\\", "\\\\0", "a\x00b"]


def test_any_text_survives_csv(spark, tmp_path):
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(TEXTS)], "id int, a string, b string")
    SNK.write_csv(df.repartition(3), str(tmp_path / "c"), rows_per_file=5)
    assert len(glob.glob(f"{tmp_path}/c/part-*")) >= 7
    for back in (SRC.read_csv_typed(spark, str(tmp_path / "c"), df.schema, multiline=True, mode="FAILFAST"),
                 SRC.read_csv_strings(spark, str(tmp_path / "c"), multiline=True),
                 SRC.read_source(spark, SourceSpec("c", str(tmp_path / "c"), schema="id int, a string, b string",
                                                   options={"multiline": "true"}))):
        got = {int(r.id): (r.a, r.b) for r in back.collect()}
        assert got == {i: (t, t) for i, t in enumerate(TEXTS)}


def test_csv_without_header_and_ddl(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb"), (2, ""), (3, None)], "id int, t string")
    SNK.write_csv(df, str(tmp_path / "c"), header=False)
    back = SRC.read_csv_ddl(spark, str(tmp_path / "c"), "id int, t string", multiline=True)
    assert {r.id: r.t for r in back.collect()} == {1: "a\nb", 2: "", 3: None}


def test_csv_reject_counts_per_file(spark, tmp_path):
    (tmp_path / "one.csv").write_text('id,n\n1,2\nx,3\n"4\n",5\n')
    (tmp_path / "two.csv").write_text("id,n\n1\n2,3\n")
    (tmp_path / "none.csv").write_text("id,n\n")
    got = SRC.csv_reject_counts(spark, str(tmp_path), "id int, n int", multiline=True)
    assert {tuple(r) for r in got.collect()} == {("one.csv", 3, 2, 4), ("two.csv", 2, 1, 3)}
    assert got.agg(F.sum("n_corrupt")).first()[0] == 3


def test_text_lines_refuse_or_escape_line_breaks(spark, tmp_path):
    texts = [t for t in TEXTS if t is not None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    with pytest.raises(Exception, match="line break"):
        SNK.write_text(df, str(tmp_path / "no"), "t")
    SNK.write_text(df, str(tmp_path / "yes"), "t", newlines="escape")
    assert spark.read.text(str(tmp_path / "yes")).count() == len(texts)
    assert sorted(r.value for r in SRC.read_text_lines(spark, str(tmp_path / "yes"), escaped=True).collect()) == sorted(texts)
    one_line = df.where(~F.col("t").rlike("[\n\r]"))
    SNK.write_text(one_line, str(tmp_path / "plain"))
    assert spark.read.text(str(tmp_path / "plain")).count() == one_line.count()
    with pytest.raises(SpecError):
        SNK.write_text(df, str(tmp_path / "x"), "t", newlines="drop")


def test_json_documents_have_a_size_and_keep_the_order(spark, tmp_path):
    df = spark.range(0, 4000, numPartitions=2).select("id", F.repeat(F.lit("é"), (F.col("id") % 50).cast("int")).alias("t"))
    SNK.write_json_documents(df, str(tmp_path / "d"), document_bytes=20_000)
    files = sorted(glob.glob(f"{tmp_path}/d/part-*"))
    sizes = [len(open(f, "rb").read()) for f in files]
    assert max(sizes) < 20_100 and sorted(sizes)[2] > 19_000  # all but the last of each task are near the size
    ids = [r["id"] for f in files for r in json.load(open(f))]
    assert ids == list(range(4000))
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    wide = spark.createDataFrame([(1, "x" * 1000), (2, "y"), (3, "z")], "id int, t string").coalesce(1)
    SNK.write_json_documents(wide, str(tmp_path / "w"), document_bytes=100)
    assert sorted(len(json.load(open(f))) for f in glob.glob(f"{tmp_path}/w/part-*")) == [1, 2]


def jdbc_call(monkeypatch, **options) -> dict:
    seen = {}
    monkeypatch.setattr(JSRC, "read_query", lambda spark, profile, query, *a, **k: seen.update(query=query, a=a, **k))
    monkeypatch.setattr(JSRC, "read_query_parallel", lambda spark, profile, query, *a, **k: seen.update(asked=a, **k))
    SRC.read_source(None, SourceSpec("s", "orders", "jdbc", options={"url": "jdbc:x://h/db", **options}))
    return seen


def test_jdbc_read_options_come_from_the_spec(monkeypatch):
    assert jdbc_call(monkeypatch) == {"query": "orders", "a": (), "fetchsize": None}
    assert jdbc_call(monkeypatch, fetch_size="500")["fetchsize"] == 500
    ranged = jdbc_call(monkeypatch, partition_column="k", num_partitions="8", lower_bound="0", upper_bound=900, fetch_size=7)
    assert ranged == {"query": "orders", "a": ("k", 0, 900, 8), "fetchsize": 7, "predicates": None}
    assert jdbc_call(monkeypatch, partition_column="k", num_partitions="8") == {"asked": ("k", 8, None)}
    assert jdbc_call(monkeypatch, predicates=["k < 5", "k >= 5"])["predicates"] == ["k < 5", "k >= 5"]
    for wrong in ({"lower_bound": 1}, {"partition_column": "k"}, {"predicates": "k < 5"}):
        with pytest.raises(SpecError):
            jdbc_call(monkeypatch, **wrong)
