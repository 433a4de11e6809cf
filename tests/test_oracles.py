"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import duckdb
import pytest

import __spark_entry__ as E
from corpusgrams import plans
from corpusgrams.sources.corpus import TABLES
from tools.check_oracles import rows_of

# the optional subpackage's queries have their own tests
QUERIES = plans.all_queries()
ORACLES = plans.all_oracles()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    scols = df.columns
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLES[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_of(scols, srows) == rows_of(dcols, drows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["order", "begins", "ends", "ngram_count"]
    assert df.count() > 0
