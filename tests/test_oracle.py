"""Every raster query against its SQL on the same tables."""

import datetime
import os

import duckdb
import pytest

from rasterloom.plans.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{f}'")
    return con


def plain(v):
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, float):
        return None if v != v else v + 0.0
    return float(v) if type(v).__name__ == "Decimal" else v


def rows(table):
    names = sorted(table.column_names)
    return names, sorted(repr(tuple(map(plain, r))) for r in zip(*(table.column(n).to_pylist() for n in names)))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    assert rows(QUERIES[name](spark, sf_dir).toArrow()) == rows(duck.execute(ORACLE_SQL[name]).to_arrow_table())
