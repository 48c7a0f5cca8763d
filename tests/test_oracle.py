"""Every registered query against its DuckDB oracle on the smallest scale,
plus the entry contract."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from vitrine.plans.registry import QUERIES
from vitrine.sources.tables import TEST_TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return str(list(v))
    return v


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TEST_TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "similarity_level" in df.columns


def test_every_query_has_an_oracle():
    # the fitted encoder (a matrix factorisation) is held against numpy in test_fitted_encoder
    assert set(QUERIES) - {"encode_fitted"} <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(E.oracle_sql())))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(cols) == sorted(rel.columns)
    assert _canon(rows, cols) == _canon(rel.fetchall(), rel.columns)
