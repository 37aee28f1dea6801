"""Every catalogue query against its DuckDB oracle at sf0.01, the way the
driver checks it: row count, column names and types, order-insensitive value
hash.  Queries without an oracle get a rows-only run."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from conformkit.plans import catalog
from tools.oracle_check import TABLES, digest, spark_type

SF = "/root/testdata/sf0.01"
NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_operator_list_and_most_have_an_oracle():
    from conformkit.plans.catalog import entries
    es = entries()
    assert all(e.operators for e in es.values())
    no_oracle = sorted(k for k, e in es.items() if e.sql is None)
    assert no_oracle == []


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and df.columns == ["source_key", "nation_key", "n_rows", "total_acctbal",
                                   "max_acctbal", "min_acctbal"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(srows) > 0
        return
    rel = duck.sql(sql)
    drows = rel.fetchall()
    assert len(srows) == len(drows)
    assert sorted(df.columns) == sorted(rel.columns)
    stypes = dict(zip(df.columns, [spark_type(f.dataType) for f in df.schema.fields]))
    dtypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert stypes == dtypes
    assert digest(df.columns, srows)[0] == digest(rel.columns, drows)[0]
