from __future__ import annotations

import random
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siftlane.llm import keeping_together as kt
from tests.conftest import rows


def components(edges):
    parent: dict = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            parent[find(a)] = find(b)
    groups: dict = {}
    for x in parent:
        groups.setdefault(find(x), set()).add(x)
    return {frozenset(g) for g in groups.values()}


def parts(df):
    groups: dict = {}
    for v, root in df.select("v", "root").collect():
        groups.setdefault(root, []).append(v)
    for root, members in groups.items():
        assert root in members and len(members) == len(set(members))
    return {frozenset(m) for m in groups.values()}


def frame(spark, edges):
    return spark.createDataFrame(edges, "a string, b string")


@pytest.mark.parametrize(
    "edges",
    [
        [("a", "b"), ("b", "a"), ("b", "b"), (None, "c"), ("a", None), ("d", "e"), ("a", "b")],
        [(f"{i:03}", f"{i + 1:03}") for i in range(60)],
        [("hub", f"leaf{i}") for i in range(80)],
        [(f"c{i % 7}-{i}", f"c{i % 7}-{(i * 31) % 90}") for i in range(90)],
    ],
)
def test_components_equal_union_find(spark, edges):
    assert parts(kt.random_mate_components(spark, frame(spark, edges))) == components(edges)


def test_no_edges(spark):
    assert kt.random_mate_components(spark, frame(spark, [])).count() == 0


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=30))
def test_random_graphs(spark, edges):
    named = [(str(a), str(b)) for a, b in edges]
    assert parts(kt.random_mate_components(spark, frame(spark, named))) == components(named)


def test_cut_meets_the_shares(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(f"r{i}", rng.randint(1, 9)) for i in range(900)], "root string, weight int")
    cut = kt.cumulative_cut(df, {"train": 0.7, "val": 0.2, "test": 0.1})
    got = {r["split"]: r["w"] for r in cut.groupBy("split").agg(F.sum("weight").alias("w")).collect()}
    total = sum(got.values())
    assert cut.count() == 900
    for name, share in {"train": 0.7, "val": 0.2, "test": 0.1}.items():
        assert abs(got[name] / total - share) < 0.01


def test_cut_refuses_bad_shares(spark):
    df = spark.createDataFrame([("r", 1)], "root string, weight int")
    for shares in ({}, {"a": 0.5}, {"a": 1.5, "b": -0.5}):
        with pytest.raises(ValueError):
            kt.cumulative_cut(df, shares)


@pytest.mark.parametrize("seed", range(3))
def test_ties_of_three_columns(spark, seed):
    rng = random.Random(seed)
    pick = lambda kind, n: rng.choice([None, None, *[f"{kind}{k}" for k in range(n)]])
    data = [(f"d{i:03}", pick("x", 60), pick("x", 40), pick("e", 50)) for i in range(150)] + [("solo", None, None, None)]
    df = spark.createDataFrame(data, "doc string, author string, source string, entity string")
    placed = rows(kt.keep_together(spark, df, ["author", "source", "entity"], "doc", {"train": 0.6, "val": 0.2, "test": 0.2}))
    edges = [(d, f"{k}{v}") for d, *values in data for k, v in enumerate(values) if v is not None]
    want = {frozenset(x for x in c if x.startswith("d")) for c in components(edges)} | {frozenset([d]) for d, *v in data if not any(v)}
    got: dict = {}
    for doc, component, split in placed:
        got.setdefault(component, set()).add((doc, split))
    assert {frozenset(d for d, _ in c) for c in got.values()} == want
    for component, members in got.items():
        assert len({s for _, s in members}) == 1 and component == min(d for d, _ in members)


def test_a_chain_through_different_columns(spark):
    data = [(f"r{i:03}", f"a{i // 2}", f"b{(i + 1) // 2}") for i in range(80)]
    df = spark.createDataFrame(data, "doc string, author string, entity string")
    assert {r["component"] for r in kt.tied_components(spark, df, ["author", "entity"], "doc").collect()} == {"r000"}


RESULTS = "run_id string, key string, split string, group_id string, leave_out_source string, assigned_at timestamp_ntz"
T = datetime(2025, 1, 1)


def results(spark, spec):
    return spark.createDataFrame([(*r, T.replace(minute=m)) for *r, m in spec], RESULTS)


@pytest.fixture
def items(spark):
    names = ["a__1", "a__2", "a__3", "b__1", "b__2", "c__1"]
    return spark.createDataFrame([(n, f"paper/{n}.jpg") for n in names], "ident string, key string")


def test_broken_ties(spark, items):
    spec = [
        ("r", "paper/a__1.jpg", "train", "paper/a__1.jpg", "c", 1), ("r", "PAPER/A__2.JPG", "Val ", "paper\\a__1.jpg", "c", 1),  # torn group
        ("r", "paper/a__3.jpg", "val", None, "c", 1), ("r", "paper/a__3.jpg", "train", " ", "c", 2), ("r", "paper/a__3.jpg", "train", " ", "c", 2),  # superseded, repeated
        ("r", "paper/c__1.jpg", "train", None, "c", 1),  # left out, not in test
        ("r", "paper/b__1.jpg", "TEST", None, "c", 1),  # in test, not left out
        ("s", "paper/b__1.jpg", "train", "paper/a__1.jpg", None, 1), ("s", "paper/b__2.jpg", "train", "paper/a__1", None, 1),  # whole group, other run
        ("s", "paper/gone__1.jpg", "test", "paper/a__1.jpg", None, 1), (None, "paper/b__1.jpg", "test", None, "c", 1), ("r", None, "test", None, "c", 1),
    ]
    current = kt.current_assignments(results(spark, spec), items)
    assert rows(kt.broken_ties(spark, current)) == {("r", "paper/a__1.jpg"), ("r", "paper/a__2.jpg"), ("r", "paper/c__1.jpg"), ("r", "paper/b__1.jpg")}


def test_new_splits_keep_ties(spark, items):
    spec = [("r", f"paper/{n}.jpg", "train", g, "c", 1) for n, g in [("a__1", "paper/a__1.jpg"), ("b__1", "paper/a__1.jpg"), ("a__2", None), ("c__1", "paper/a__3.jpg"), ("a__3", "paper/a__3.jpg")]]
    placed = {r["key"]: r["split"] for r in kt.assign_splits(spark, kt.current_assignments(results(spark, spec), items)).collect()}
    assert placed["paper/a__1.jpg"] == placed["paper/b__1.jpg"] != "test"
    assert placed["paper/c__1.jpg"] == placed["paper/a__3.jpg"] == "test" and len(placed) == 5


def test_empty(spark, items):
    current = kt.current_assignments(results(spark, []), items)
    assert kt.broken_ties(spark, current).count() == 0 and kt.assign_splits(spark, current).count() == 0


def test_extra_columns_with_clashing_names(spark, items):
    spec = [("r", "paper/a__1.jpg", "train", "paper/a__1.jpg", None, 1), ("r", "paper/a__2.jpg", "val", "paper/a__1.jpg", None, 1)]
    noisy = results(spark, spec).withColumns({c: F.lit("x") for c in ("ident", "now", "source", "group", "v", "root", "component", "_hub")})
    more = items.withColumns({c: F.lit("y") for c in ("run_id", "split", "group", "source")})
    assert rows(kt.broken_ties(spark, kt.current_assignments(noisy, more))) == {("r", "paper/a__1.jpg"), ("r", "paper/a__2.jpg")}
