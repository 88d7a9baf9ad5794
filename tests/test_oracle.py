"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import duckdb
import pytest

from tools.check_oracle import TABLES, canon

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield c
    c.close()


def _names():
    from oracle_queries import ORACLE_SQL
    return sorted(ORACLE_SQL)


def test_every_query_has_an_oracle():
    from aeris.plans.registry import QUERIES
    from oracle_queries import ORACLE_SQL
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    from __spark_entry__ import oracle_sql, queries
    got = queries()[name](spark, SF).toPandas()
    want = con.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canon(got) == canon(want)


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() >= 0
    assert "climate_vulnerability_index" in df.columns
