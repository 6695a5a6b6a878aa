"""Every registered query against its SQL at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from shelfwise.plans import registered

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
QUERIES = registered.QUERIES
ORACLES = registered.ORACLES
# Random or iterative fits, checked by their properties in the other tests.
WITHOUT_SQL = {
    "h04_ivf_build_kmeans", "h07_pq_recall", "i01_fit_codebooks_kmeans",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS FROM '{SF}/{name}.parquet'")
    return con


def key(value):
    return f"{value:.9g}" if isinstance(value, float) else str(value)


def test_only_fits_go_without_sql():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLES[name])
    expected_cols = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    assert sorted(df.columns) == sorted(expected_cols)
    cols = sorted(df.columns)
    got = sorted(tuple(key(r[c]) for c in cols) for r in df.collect())
    want = sorted(tuple(key(r[expected_cols.index(c)]) for c in cols) for r in expected)
    assert got == want
    assert got


def test_entry_has_all():
    assert QUERIES.items() <= entry.queries().items()
    assert ORACLES.items() <= entry.oracle_sql().items()


def test_entry(spark):
    assert entry.entry(spark).count() > 0
