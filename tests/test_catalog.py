"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from arcloom import catalog, catalog_tables  # noqa: F401

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for name in os.listdir(DATA):
        c.sql(f"create view {name.split('.')[0]} as select * from read_parquet('{DATA}/{name}')")
    return c


def rows(df: pd.DataFrame):
    df = df[sorted(df.columns)].astype(object)
    return sorted(tuple("~" if pd.isna(x) else str(int(x)) if isinstance(x, float) and x == int(x) else str(x) for x in r) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, DATA).toPandas()
    if name not in catalog.ORACLE_SQL:
        assert len(got)
        return
    want = duck.sql(catalog.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_flagship(spark):
    out = catalog.flagship(spark, DATA)
    assert {"tier", "bsj_consensus", "isoform_label"} <= set(out.columns) and not out.isEmpty()


def test_closure_counts(spark):
    assert catalog.QUERIES["closure_relaxed"](spark, DATA).count() == 656


def test_no_query_reads_a_slice():
    for name, sql in catalog.ORACLE_SQL.items():
        assert "sample = 'S0' AND" not in sql and "l_orderkey % 4 = 0" not in sql, name
    assert not [q for q in catalog.QUERIES if q.endswith("_all")] and set(catalog.ORACLE_SQL) == set(catalog.QUERIES)
