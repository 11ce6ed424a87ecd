from __future__ import annotations

import random
from datetime import datetime
from itertools import product

import pytest
from pyspark.sql import functions as F

from siftlane.llm import survivors as sv
from tests.conftest import rows


def cost(bundles, levels, picks):
    out = [0] * (max(levels) + 1)
    for k, (i, level) in enumerate(zip(picks, levels, strict=True)):
        out[level] += sv.EMPTY if i is None else bundles[k][i][0]
    return out


def brute(bundles, levels):
    best = None
    for combo in product(*[[*range(len(b)), None] for b in bundles]):
        known: dict = {}
        fine = True
        for k, i in enumerate(combo):
            if i is not None:
                for d, v in bundles[k][i][1].items():
                    if v is not None:
                        fine &= known.setdefault(d, v) == v
        if fine and (best is None or cost(bundles, levels, combo) < best):
            best = cost(bundles, levels, combo)
    return best


@pytest.mark.parametrize("levels", [(0, 0, 0), (0, 1, 1), (0, 1, 2), (1, 0, 1)])
@pytest.mark.parametrize("seed", range(20))
def test_search_equals_all_combinations(seed, levels):
    rng = random.Random(seed)
    bundles = [[(r, {"x": rng.choice("ab") if rng.random() < 0.8 else None, "y": rng.choice("pq")}) for r in rng.sample(range(9), rng.randint(0, 4))] for _ in range(3)]
    assert cost(bundles, levels, sv.branch_and_bound(bundles, levels)) == brute(bundles, levels)


def test_an_empty_bundle_of_a_lower_level_costs_no_trust():
    """The most trusted label's class lacks a box."""
    label = [(0, {"class": "paper"}), (1, {"class": "metal"})]
    box = [(0, {"class": "metal"})]
    assert sv.branch_and_bound([label, box], [0, 1]) == [0, None]
    assert sv.branch_and_bound([label, box], [0, 0]) == [1, 0]


T = datetime(2025, 1, 1)


@pytest.fixture
def tables(spark):
    keys = ["paper/a__1.jpg", "paper/b__1.jpg", "metal/b__2.jpg", "metal/c__1.jpg", "glass/d__1.jpg"]
    labels = [None, "x.txt", "x.txt", "x.txt", "n/a"]
    items = spark.createDataFrame([*zip(keys, labels, strict=True), (keys[0], " "), (keys[4], None)], "key string, label string")
    idents = spark.createDataFrame([(k.split("/")[1][:-4], k) for k in keys], "ident string, key string")
    specs = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "source string, priority int")
    drops = spark.createDataFrame(
        [("paper/b__1.jpg", "paper/a__1.jpg"), ("METAL\\B__2.JPG", "paper/a__1.jpg"), ("metal/b__2.jpg", " paper/a__1.jpg"), ("metal/c__1.jpg", "metal/b__2"), ("x__9.jpg", "metal/b__2.jpg"), ("glass/d__1.jpg", "glass/d__1.jpg"), (None, "gone__1.jpg"), ("paper/b__1.jpg", None)],
        "key string, duplicate_of string",
    )
    return idents, items, specs, drops


def records(spark, spec):
    return spark.createDataFrame([(i, img, c, None if m is None else T.replace(minute=m)) for i, img, c, m in spec], "record_id bigint, image string, confidence double, boxed_at timestamp_ntz")


def test_members(tables):
    idents, _, _, drops = tables
    got = rows(sv.duplicate_members(drops, idents), "group_key", "key")
    assert got == {
        ("paper/a__1.jpg", "paper/a__1.jpg"), ("paper/a__1.jpg", "paper/b__1.jpg"), ("paper/a__1.jpg", "metal/b__2.jpg"),
        ("metal/b__2.jpg", "metal/b__2.jpg"), ("metal/b__2.jpg", "metal/c__1.jpg"), ("glass/d__1.jpg", "glass/d__1.jpg"),
    }


def test_field_by_field(spark, tables):
    idents, items, specs, drops = tables
    recs = records(spark, [(9, "a__1.jpg", 0.5, 1), (8, "B__1.JPG", 0.4, 2), (7, "b__1.png", 0.6, 2), (6, "b__1.png", 0.6, 2), (5, "a__1.jpg", 1.5, 3), (4, "a__1.jpg", float("nan"), 4), (3, "a__1.jpg", 0.0, 5), (2, "c__1.jpg", None, 5), (1, "c__1.jpg", 1.0, None), (1, "c__1.jpg", 1.0, None)])
    got = rows(sv.representatives(sv.duplicate_members(drops, idents), items, specs, recs))
    # Group a: both b items have a label, the smaller key wins; its latest record at the best confidence has the smaller id.
    assert got == {("paper/a__1.jpg", "metal/b__2.jpg", 6), ("metal/b__2.jpg", "metal/b__2.jpg", 1), ("glass/d__1.jpg", "", 0)}


def test_same_class_ties_the_bundles(spark, tables):
    idents, items, specs, drops = tables
    recs = records(spark, [(6, "b__1.jpg", 0.6, 9), (5, "b__2.jpg", 0.6, 1)])
    got = {r["group_key"]: (r["label_key"], r["record_id"]) for r in sv.representatives(sv.duplicate_members(drops, idents), items, specs, recs, same_class=True).collect()}
    assert got["paper/a__1.jpg"] == ("metal/b__2.jpg", 5)


def test_large_group_sends_few_rows(spark):
    cand = spark.range(20000).select(F.lit("g").alias("group"), F.lit("label").alias("bundle"), F.struct((20000 - F.col("id")).alias("first")).alias("trust"), F.create_map(F.lit("c"), (F.col("id") % 3).cast("string")).alias("determinants"), F.col("id").cast("string").alias("candidate"))
    assert rows(sv.best_representative(cand, ["label"])) == {("g", "label", "19999")}


def test_empty(spark, tables):
    idents, items, specs, drops = tables
    none = sv.duplicate_members(drops.where("false"), idents)
    assert sv.representatives(none, items, specs, records(spark, [])).count() == 0


def test_extra_columns_with_clashing_names(spark, tables):
    idents, items, specs, drops = tables
    clash = lambda df, *cols: df.withColumns({c: F.lit("x") for c in cols if c not in df.columns})
    members = clash(sv.duplicate_members(clash(drops, "ident", "kept", "gone", "group_key"), clash(idents, "kept", "group_key", "gone")), "source", "priority", "record_id", "label")
    recs = clash(records(spark, [(6, "b__1.jpg", 0.6, 9)]), "ident", "group_key", "key", "source")
    got = rows(sv.representatives(members, clash(items, "ident", "source", "group_key"), clash(specs, "ident", "key"), recs))
    assert got == {("paper/a__1.jpg", "metal/b__2.jpg", 6), ("metal/b__2.jpg", "metal/b__2.jpg", 0), ("glass/d__1.jpg", "", 0)}


def test_the_most_trusted_label_stays_without_a_box_of_its_class(spark, tables):
    idents, items, specs, drops = tables
    recs = records(spark, [(6, "b__1.jpg", 0.6, 9)])
    got = {r["group_key"]: (r["label_key"], r["record_id"]) for r in sv.representatives(sv.duplicate_members(drops, idents), items, specs, recs, same_class=True).collect()}
    assert got["paper/a__1.jpg"] == ("metal/b__2.jpg", 0)
