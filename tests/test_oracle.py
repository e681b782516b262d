"""Every query with an oracle gives the rows DuckDB gives on the smallest tables; the others run and return rows."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, canon

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return c


NAMES = sorted(entry.oracle_sql())


# Every fourth query by default (some minutes less); MEADOW_ALL_ORACLES=1 runs them all, as check.py does.
@pytest.mark.parametrize("name", NAMES if os.environ.get("MEADOW_ALL_ORACLES") else NAMES[::4])
def test_matches_oracle(spark, con, name):
    got = canon(entry.queries()[name](spark, FOLDER).toPandas())
    want = canon(con.execute(entry.oracle_sql()[name]).df())
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
