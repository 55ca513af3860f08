"""Every query of the catalog against its SQL twin on the smallest given tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from pactframe.plans import catalog, oracle
from tools.check import TABLES, key, plain

NAMES = list(catalog.QUERIES)


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def test_every_query_has_a_twin():
    assert set(oracle.ORACLE) == set(NAMES)
    assert set(NAMES) <= set(entry.queries()) and set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, sf, db, name):
    df = entry.queries()[name](spark, sf)
    order = sorted(df.columns)
    rel = db.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in rel.description]
    assert sorted(cols) == order
    want = sorted((tuple(plain(r[cols.index(c)]) for c in order) for r in rel.fetchall()), key=key)
    got = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=key)
    assert got == want


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and all(r.ok for r in rows)
    assert all(r.cp_text_chars == r.cp_chars + r.n_cp - 1 for r in rows)
