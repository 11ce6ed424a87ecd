from __future__ import annotations

import random

import numpy as np
import pytest

from siftlane.llm import linking
from tests.conftest import rows
from tests.llm.test_keeping_together import components


def check(spark, edges, **kw):
    df = spark.createDataFrame(edges, "a string, b string, v string, cell int")
    want = {(v, min(g)) for g in components([e[:2] for e in edges]) for v in g}
    assert rows(linking.grid_components(spark, df, **kw)) == want


def edges_of(kind):
    rng = random.Random(3)
    if kind == "chain":
        return [(f"{i:04}", f"{i + 1:04}") for i in range(300)]
    if kind == "star":
        return [("mmm", f"{i:04}") for i in range(300)]
    if kind == "random":
        return [(str(rng.randrange(400)), str(rng.randrange(400))) for _ in range(260)]
    return [("a", "b"), ("b", "a"), ("a", "b"), ("b", "b"), (None, "a"), ("x", None), ("ö", "z"), ("z", "Z")]


@pytest.mark.parametrize("kind", ["chain", "star", "random", "odd"])
def test_equal_to_union_find(spark, kind):
    check(spark, [(*e, "clash", 0) for e in edges_of(kind)])


def test_cells_cut_into_parts(spark):
    check(spark, [(*e, None, None) for e in edges_of("star")], cell_edges=16)


def test_no_edges(spark):
    assert linking.grid_components(spark, spark.createDataFrame([], "a string, b string")).count() == 0


def test_local_minima():
    a, b = np.array([1, 3, 5, 2]), np.array([2, 4, 1, 0])
    assert linking.local_minima(a, b, 7).tolist() == [0, 0, 0, 3, 3, 0, 6]
