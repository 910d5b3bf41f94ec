"""Every registered query equals its SQL."""

import os

import duckdb
import pytest
from lakeloom.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents labels".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from '{path}'")
    return con


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    rows = df.collect()
    assert rows
    assert name in catalog.ORACLES
    found = duck.execute(catalog.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    want = [tuple(r[names.index(c)] for c in df.columns) for r in found.fetchall()]
    assert ordered(map(tuple, rows)) == ordered(want)


def test_every_oracle_has_a_query():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)


def test_entry_point(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries()) and set(catalog.QUERIES) <= set(e.queries())
