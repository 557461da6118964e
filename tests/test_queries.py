"""Every report query against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

from trustlake.plans import ORACLE, QUERIES

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents pages".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return c


def rows(records, columns):
    plain = lambda v: None if v is None or isinstance(v, float) and math.isnan(v) else round(v, 9) if isinstance(v, float) else v
    order = sorted(columns)
    return sorted((tuple(plain(r[columns.index(c)]) for c in order) for r in records), key=repr)


def test_names_agree():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, DIR)
    want = duck.sql(ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows([tuple(r) for r in got.collect()], got.columns) == rows(want.fetchall(), want.columns)
