"""The pN_found queries that SQL can express give the same rows as the SQL; the others run."""

from __future__ import annotations

import os

import duckdb
import pytest

from siftlane.llm.queries import QUERIES, SQL
from tests.conftest import SF
from tests.test_queries_against_sql import same


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    same(QUERIES[name](spark, SF), duck, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs_and_has_no_row_twice(spark, name):
    got = [tuple(map(str, r)) for r in QUERIES[name](spark, SF).collect()]
    assert got and (not name.endswith("_found") or len(got) == len(set(got)))
