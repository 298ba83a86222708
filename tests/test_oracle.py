"""Differential test: every registered query against its DuckDB SQL on the driver tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E

from civicmart.plans.bindings import QUERIES
from civicmart.plans.oracle import ORACLE_SQL

from conftest import TESTDATA

SF = os.environ.get("CIVICMART_ORACLE_SF", "sf0.001")
SF_DIR = f"{TESTDATA}/{SF}"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver test data not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    yield con
    con.close()


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float) and math.isnan(v):
            return "nan"
        return v

    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_oracle_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_duckdb(spark, duck, name):
    df = E.queries()[name](spark, SF_DIR)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert canon(df.columns, rows) == canon(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[0] == "date" and df.count() > 0
