import duckdb
import pytest

import __spark_entry__ as E
from adtrail.plans import registry
from adtrail.sources.testdata import TABLES
from conftest import SMOKE


def test_entry_runs_with_fact_schema(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[-1] == "dt" and "is_invalid_traffic" in df.columns


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(registry.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "as_tuple"):
        return str(v)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return v


def _key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMOKE}/{t}.parquet'")
    return con


@pytest.mark.parametrize("key", sorted(registry.ORACLE))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SMOKE)
    rel = duck.sql(E.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _key(df.columns, df.collect()) == _key(rel.columns, rel.fetchall())
