"""Every registered query against its SQL, on the small driver tables."""

from __future__ import annotations

import math
import os
from datetime import datetime

import duckdb
import pytest

import __spark_entry__ as driver

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, datetime):
        return value.isoformat()
    return value


def as_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(driver.QUERIES) <= set(driver.oracle_sql()) <= set(driver.queries())


def test_flagship(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(driver.QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    out = driver.queries()[name](spark, SF_DIR)
    got = as_rows(out.columns, out.collect())
    cursor = duck.execute(driver.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    assert sorted(names) == sorted(out.columns)
    assert got == as_rows(names, cursor.fetchall())
