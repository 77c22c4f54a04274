"""Every registered query with SQL gives the rows that DuckDB gives for it."""

import datetime
import decimal

import duckdb
import pytest

from ledgerlake.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, datetime.datetime):
        return str(v.replace(tzinfo=None))
    return float(v) if isinstance(v, decimal.Decimal) else v


def rows(columns, found):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(r[k]) for k in order) for r in found), key=str)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    if name not in catalog.ORACLES:
        catalog.QUERIES[name](spark, SF).collect()
        return
    ours, theirs = catalog.QUERIES[name](spark, SF), duck.sql(catalog.ORACLES[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours.columns, ours.collect()) == rows(theirs.columns, theirs.fetchall())
