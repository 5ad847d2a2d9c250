"""Every query against its SQL over the smallest tables."""

import os

import duckdb
import pytest

from wirelens.plans import oracles, queries


@pytest.fixture(scope="module")
def db(sf):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.sql(f"create view {f[:-8]} as select * from '{sf}/{f}'")
    return c


def plain(df):
    cols = sorted(df.columns)
    value = lambda v: "~" if v is None or v != v else str(v) if isinstance(v, str) else float(v)
    return cols, sorted(repr([value(v) for v in r]) for r in df[cols].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_equals_sql(spark, sf, db, name):
    got, want = queries.queries()[name](spark, sf).toPandas(), db.sql(oracles.ORACLES[name]).df()
    assert plain(got) == plain(want)


def test_every_query_is_covered():
    assert set(queries.QUERIES) == set(oracles.ORACLES) | queries.WRITING


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
