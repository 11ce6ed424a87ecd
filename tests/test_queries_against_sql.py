"""Every core query that has SQL gives the same rows as that SQL, on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from siftlane.plans.queries import QUERIES, SQL
from tests.conftest import SF


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return tuple(map(plain, value)) if isinstance(value, list) else value


def same(df, duck, sql):
    cols = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(*cols).collect()), key=repr)
    want = sorted((tuple(map(plain, r)) for r in duck.execute(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    same(QUERIES[name](spark, SF), duck, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
