"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import os

import duckdb
import pytest

from tools.check_oracle import TABLES, rows

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


def _names():
    from __spark_entry__ import queries
    return sorted(queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    from __spark_entry__ import oracle_sql, queries
    got = queries()[name](spark, SF).toPandas()
    sql = oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
        return
    want = con.execute(sql).df()
    gc, gr = rows(got)
    wc, wr = rows(want)
    assert gc == wc
    assert gr == wr


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["entity_id", "performance", "events"]
    assert df.count() > 0
