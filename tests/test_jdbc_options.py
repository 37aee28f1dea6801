"""JDBC options as Spark receives them (no database is started: the reader and
writer are stand-ins that record what they are given)."""

from __future__ import annotations

import pytest

from conformkit.sinks import jdbc as JSNK
from conformkit.sources import jdbc as JSRC
from conformkit.specs import ConnectionProfile, SpecError


class _Reader:
    def __init__(self, log):
        self.log = log

    def format(self, f):
        self.log["format"] = f
        return self

    def options(self, **o):
        self.log.update(o)
        return self

    def load(self):
        return "frame"


class _FakeSpark:
    def __init__(self):
        self.log = {}
        self.read = _Reader(self.log)


class _Writer(_Reader):
    def mode(self, m):
        self.log["mode"] = m
        return self

    def save(self):
        self.log["saved"] = True


class _FakeFrame:
    def __init__(self):
        self.log = {}
        self.write = _Writer(self.log)


PROFILE = ConnectionProfile(url="jdbc:x://h/db", driver="x.Driver", user="u", password="p")


def test_source_sql_is_a_dbtable_subquery_with_fetchsize():
    spark = _FakeSpark()
    JSRC.read_query(spark, PROFILE, "SELECT a, b FROM t")
    assert spark.log["format"] == "jdbc"
    assert spark.log["dbtable"] == "(SELECT a, b FROM t) src"  # D14: never the `query` option
    assert "query" not in spark.log
    assert spark.log["fetchsize"] == "10000"
    assert "partitionColumn" not in spark.log


def test_range_read_sets_all_four_options():
    spark = _FakeSpark()
    JSRC.read_query(spark, PROFILE, "SELECT id FROM t", partition_column="id",
                    lower_bound=0, upper_bound=1000, num_partitions=8)
    assert (spark.log["partitionColumn"], spark.log["lowerBound"], spark.log["upperBound"],
            spark.log["numPartitions"]) == ("id", "0", "1000", "8")


def test_overwrite_truncates_and_append_does_not():
    df = _FakeFrame()
    JSNK.write_jdbc(df, PROFILE, "target_t", mode="overwrite", max_connections=16)
    assert df.log["truncate"] == "true" and df.log["mode"] == "overwrite"  # D15
    assert df.log["dbtable"] == "target_t" and df.log["numPartitions"] == "16"
    df2 = _FakeFrame()
    JSNK.write_jdbc(df2, PROFILE, "target_t", mode="append")
    assert "truncate" not in df2.log and df2.log["mode"] == "append"
    with pytest.raises(SpecError):
        JSNK.write_jdbc(_FakeFrame(), PROFILE, "t", mode="ignore")


def test_named_connections():
    profiles = {"tgt": PROFILE}
    df = _FakeFrame()
    JSNK.write_named(df, profiles, "tgt", "t1")
    assert df.log["url"] == PROFILE.url and df.log["user"] == "u"
    with pytest.raises(SpecError, match="unknown connection"):
        JSRC.read_named(_FakeSpark(), profiles, "nope", "SELECT 1")
