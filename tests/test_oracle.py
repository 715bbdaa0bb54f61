"""Registered queries against their SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import os

import pytest

from lodestone import registry

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def _plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, float):
        return round(v, 5) + 0.0
    return int(v) if hasattr(v, "dtype") and "int" in str(v.dtype) else str(v)


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(repr([_plain(v) for v in row]) for row in pdf[cols].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = _rows(registry.queries()[name](spark, DATA).toPandas())
    want = _rows(duck.sql(registry.oracle_sql()[name]).df())
    assert got == want


def test_every_sql_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())
