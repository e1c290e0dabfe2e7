"""Every SQL-checked query equals its DuckDB oracle on the sf0.001 tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def c(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 6) + 0.0
        return v.isoformat() if hasattr(v, "isoformat") else v
    return sorted((tuple(c(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert _canon(srows, scols) == _canon(drows, dcols)


def test_every_query_has_a_callable_and_entry_runs(spark):
    assert set(E.oracle_sql()) <= set(E.queries())
    assert E.entry(spark).count() >= 0
