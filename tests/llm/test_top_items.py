from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from siftlane.llm import top_items
from siftlane.llm.top_items import band_edges, top_n
from tests.conftest import rows

SCHEMA = "g string, score double, tie string, id bigint, rank int, band int, have int"


def brute(data, n):
    best: dict = {}
    for g, s, t, i, *_ in data:
        if g is not None and s is not None and s == s:
            key = (g, s, t)
            best[key] = min(best.get(key, i), i)
    out = set()
    for g in {k[0] for k in best}:
        ranked = sorted(((-s, t is not None, t or "", i, s, t) for (h, s, t), i in best.items() if h == g))
        out |= {(g, s, t, i, r + 1) for r, (*_, i, s, t) in enumerate(ranked[:n])}
    return out


@pytest.mark.parametrize(("n", "bands"), [(3, 4), (1, 1), (5, 3)])
def test_equal_to_sorting(spark, n, bands):
    rng = random.Random(n)
    data = []
    for i in range(1500):
        g = rng.choice(["hot"] * 5 + [f"g{k}" for k in range(60)] + [None])
        s = rng.choice([None, float("nan"), 0.5, 0.5, 1.0, round(rng.random(), 2)])
        data.append((g, s, rng.choice(["a", "b", "ü", "", None]), rng.randrange(900), 7, 7, 7))
    data += data[:100]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(top_n(spark, df, "g", "score", ["tie"], "id", n=n, bands=bands), "g", "score", "tie", "id", "rank") == brute(data, n)


def made(rng, rows_, groups):
    return [(rng.choice(["hot"] * 5 + [f"g{k}" for k in range(groups)]), round(rng.random(), 4), rng.choice(["a", "b", None]), i, 7, 7, 7) for i in range(rows_)]


def test_more_items_than_spark_limits_ranks_for(spark, monkeypatch):
    monkeypatch.setattr(top_items, "PART_ROWS", 1000)
    data = made(random.Random(8), 12_000, 2)
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(top_n(spark, df, "g", "score", ["tie"], "id", n=2000), "g", "score", "tie", "id", "rank") == brute(data, 2000)


@pytest.mark.parametrize("listed", [0, 20])
def test_every_way_of_leaving_filled_groups_out(spark, monkeypatch, listed):
    monkeypatch.setattr(top_items, "LISTED", listed)
    data = made(random.Random(9), 3000, 60)
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(top_n(spark, df, "g", "score", ["tie"], "id"), "g", "score", "tie", "id", "rank") == brute(data, 3)


def test_bands_where_scores_pile_up(spark):
    df = spark.createDataFrame([(0.0,), *[(1 - 1e-6 * (x % 997),) for x in range(2000)]], "score double")
    sizes = [df.where(F.col("score") >= e).count() for e in band_edges(df, "score", 4)]
    assert len(sizes) == 4 and 300 < sizes[0] < 700 and 800 < sizes[1] < 1200


def test_edges(spark):
    df = spark.createDataFrame([(float(x % 100),) for x in range(1000)], "score double")
    edges = band_edges(df, "score", 4)
    assert len(edges) == 4 and edges == sorted(edges, reverse=True) and edges[-1] == float("-inf")
    assert band_edges(df.where("false"), "score", 4) == [float("-inf")]
    assert band_edges(df.withColumn("score", F.lit(1.0)), "score", 4) == [float("-inf")]


def test_empty(spark):
    assert top_n(spark, spark.createDataFrame([], SCHEMA), "g", "score", ["tie"], "id").count() == 0
    with pytest.raises(ValueError):
        top_n(spark, spark.createDataFrame([], SCHEMA), "g", "score", ["tie"], "id", n=0)
