"""Registered queries against their oracle on the smallest tables."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from lociq.plans import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    clean = lambda v: round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(clean(r[k]) for k in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_oracle(spark, oracle, name):
    got = QUERIES[name](spark, SF)
    cur = oracle.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(got.columns) == sorted(names)
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(names, cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() >= 0


def test_driver_contract(spark):
    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())
