from __future__ import annotations

import hashlib
from collections import Counter
from datetime import datetime

import pytest

from siftlane.llm import quota_sampling as qs
from tests.conftest import rows

T = datetime(2025, 1, 1)


@pytest.fixture
def weights(spark):
    m = [(1, {"Paper ": 2, "paper": 1, "METAL": 1, "shoes": 90, "glass": 0, "organic": None}, T), (1, {"Paper ": 2, "paper": 1, "METAL": 1, "shoes": 90, "glass": 0, "organic": None}, T), (2, {"DROP": 3}, T), (None, {"paper": 1}, T), (3, None, T)]
    return qs.class_weights(spark.createDataFrame(m, "manifest_id bigint, class_counts map<string,int>, remapped_at timestamp_ntz"))


def test_weights(weights):
    assert rows(weights) == {(1, "paper", 3, 4), (1, "metal", 1, 4)}


@pytest.fixture
def pool(spark):
    return spark.createDataFrame([("r", "paper", f"p{i:03}") for i in range(100)] + [("r", "metal", f"m{i}") for i in range(2)] + [("s", "paper", "q")], "run_id string, class_name string, key string")


def plan(spark, *spec):
    return spark.createDataFrame(list(spec), "plan_id bigint, run_id string, manifest_id bigint, sample_size int, min_rows int")


def test_quotas_draws_and_shortfalls(spark, weights, pool):
    wanted = qs.quotas(plan(spark, (1, "r", 1, 10, 0), (2, "r", 1, 10, 5), (3, "s", 1, 1, None), (4, "r", 2, 9, 9), (5, "none", 1, 4, 0)), weights)
    assert rows(wanted, "plan_id", "class_name", "quota") == {(1, "paper", 8), (1, "metal", 3), (2, "paper", 8), (2, "metal", 5), (3, "paper", 1), (3, "metal", 1), (5, "paper", 3), (5, "metal", 1)}
    counts = pool.groupBy("run_id", "class_name").count().withColumnRenamed("count", "available")
    report = qs.quota_report(counts, wanted)
    assert rows(report.where("exhausted"), "plan_id", "class_name", "available") == {(1, "metal", 2), (2, "metal", 2), (3, "metal", 0), (5, "paper", 0), (5, "metal", 0)}
    sample, full = qs.draw(pool, wanted)
    assert rows(full) == rows(report.select(*full.columns))
    drawn = sample.collect()
    assert Counter((r["plan_id"], r["class_name"]) for r in drawn) == {(1, "paper"): 8, (1, "metal"): 2, (2, "paper"): 8, (2, "metal"): 2, (3, "paper"): 1}
    assert len({tuple(r) for r in drawn}) == len(drawn)


def test_reservoirs_merge_and_are_uniform(spark, pool):
    sizes = spark.createDataFrame([("r", "paper", 10)], "run_id string, class_name string, k int")
    one = rows(qs.reservoirs(pool, ["run_id", "class_name"], "key", sizes, 1)[0])
    assert one == rows(qs.reservoirs(pool.repartition(13), ["run_id", "class_name"], "key", sizes, 1)[0]) and len(one) == 10
    seen = Counter(k for s in range(40) for _, _, k, _ in rows(qs.reservoirs(pool, ["run_id", "class_name"], "key", sizes, s)[0]))
    assert len(seen) > 90 and max(seen.values()) < 15


def test_large_reservoirs_and_counts(spark, monkeypatch):
    """5,000 of 20,000 rows, beside a small stratum and one without a size; trimmed many times on the way."""
    monkeypatch.setattr(qs, "HELD", 100)
    keys = [("r", "paper", f"p{i}") for i in range(20_000)] + [("r", "metal", f"m{i}") for i in range(40)] + [("t", "paper", "x"), (None, "paper", "y")]
    pool = spark.createDataFrame(keys, "run_id string, class_name string, key string").repartition(5)
    sizes = spark.createDataFrame([("r", "paper", 5000), ("r", "metal", 30), ("none", "glass", 3)], "run_id string, class_name string, k int")
    kept, counts = qs.reservoirs(pool, ["run_id", "class_name"], "key", sizes, 3)
    order = {c: sorted((hashlib.md5(f"3:{r}:{c}:{k}".encode()).hexdigest(), k) for r, c2, k in keys if r == "r" and c2 == c) for c in ("paper", "metal")}
    want = {("r", c, k, n + 1) for c, most in (("paper", 5000), ("metal", 30)) for n, (_, k) in enumerate(order[c][:most])}
    assert rows(kept) == want
    assert rows(counts) == {("r", "paper", 20_000), ("r", "metal", 40), ("t", "paper", 1)}


def test_empty(spark, weights, pool):
    wanted = qs.quotas(plan(spark, (1, "r", 1, 10, 0)).where("false"), weights)
    assert qs.draw(pool, wanted)[0].count() == 0
    assert qs.draw(pool.where("false"), qs.quotas(plan(spark, (1, "r", 1, 10, 0)), weights))[0].count() == 0


def test_extra_columns_with_clashing_names(spark, weights, pool):
    from pyspark.sql import functions as F

    clash = lambda df, *cols: df.withColumns({c: F.lit("x") for c in cols if c not in df.columns})
    wanted = clash(qs.quotas(clash(plan(spark, (1, "r", 1, 10, 0)), "n", "total", "class_name", "quota"), clash(weights, "plan_id", "sample_size")), "key", "place", "k", "available", "spot")
    counts = clash(pool.groupBy("run_id", "class_name").count().withColumnRenamed("count", "available"), "quota", "plan_id", "taken")
    assert rows(qs.quota_report(counts, wanted), "class_name", "taken") == {("paper", 8), ("metal", 2)}
    assert qs.draw(clash(pool, "quota", "plan_id", "k", "place", "spot"), wanted)[0].count() == 10
