"""Every registered query equals its DuckDB oracle (row count, columns,
order-insensitive values) on the smallest driver tables."""

import pytest

import __spark_entry__ as entry
from scripts.check_oracle import canon, duck
from tests.conftest import SF_SMALL

from hivewire.plans.catalog import batch_queries
from hivewire.streaming.jobs import stream_queries

CORE = {**batch_queries(), **stream_queries()}
QUERIES = {k: v for k, v in entry.queries().items() if k in CORE}
SQL = {k: v for k, v in entry.oracle_sql().items() if k in CORE}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(CORE) == set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    rel = con.execute(SQL[name])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert canon(df.columns, srows) == canon(dcols, drows)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["event_id", "building", "query_id", "n_items", "items"]
