"""Duplicates, groups, balance, split, quality, boxes, remap; expected values worked out by hand or by brute force."""

from __future__ import annotations

import math
import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftlane.functions import boxes as bx
from siftlane.functions.hashing import perceptual_hash, similarity_hash
from siftlane.operators import autobox, balance, checks, dedup, graph, qa, quality, remap, reports, split
from tests.conftest import rows

# ---- duplicates


def hashed(spark, spec):
    return spark.createDataFrame(spec, "key string, prio int, h bigint")


def sequential(items):
    kept, out = [], {}
    for key, _, h in sorted(items, key=lambda x: (x[1], x[0])):
        for other, g in kept:
            d = ((h ^ g) & (2**64 - 1)).bit_count()
            if d <= 2:
                out[key] = (False, other, d)
                break
        else:
            kept.append((key, h))
            out[key] = (True, None, None)
    return out


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def test_chain_is_not_a_component(spark):
    got = {r["key"]: tuple(r)[1:] for r in dedup.greedy_dedup(spark, hashed(spark, [("a", 0, 0), ("b", 0, 0b11), ("c", 0, 0b1111)])).collect()}
    assert got == {"a": (True, None, None), "b": (False, "a", 2), "c": (True, None, None)}


def test_first_kept_match_not_nearest_and_priority(spark):
    got = {r["key"]: tuple(r)[1:] for r in dedup.greedy_dedup(spark, hashed(spark, [("z", 0, 0b11), ("y", 1, 0b11110000), ("x", 2, 0b10), ("w", 3, 0b11110000), ("n", 1, None)])).collect()}
    assert got == {"z": (True, None, None), "y": (True, None, None), "x": (False, "z", 1), "w": (False, "y", 0)}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_greedy_equals_replay(spark, seed):
    rng = random.Random(seed)
    bases = [rng.getrandbits(64) for _ in range(12)]
    items = []
    for i in range(220):
        h = rng.choice(bases)
        for _ in range(rng.randint(0, 4)):
            h ^= 1 << rng.randrange(64)
        items.append((f"k{i:03}", rng.randint(0, 3), signed(h)))
    got = {r["key"]: tuple(r)[1:] for r in dedup.greedy_dedup(spark, hashed(spark, items)).collect()}
    assert got == sequential(items)
    place = {k: (p, k) for k, p, _ in items}
    h = {k: x for k, _, x in items}
    kept = [k for k, v in got.items() if v[0]]
    want = {(min(a, b, key=place.get), max(a, b, key=place.get), d) for a, b in combinations(kept, 2) if 3 <= (d := ((h[a] ^ h[b]) & (2**64 - 1)).bit_count()) <= 8}
    edges = dedup.near_edges(hashed(spark, [i for i in items if i[0] in set(kept)]))
    assert rows(edges) == want


def test_near_band(spark):
    kept = hashed(spark, [("a", 0, 0), ("b", 0, 0b111), ("c", 1, 0xFF), ("d", 1, 0xFFFFF)])
    edges = dedup.near_edges(kept)
    assert rows(edges) == {("a", "b", 3), ("a", "c", 8), ("b", "c", 5)}
    sources = spark.createDataFrame([("a", "t"), ("b", "g"), ("c", "g"), ("d", "g")], "key string, source string")
    assert rows(dedup.source_matrix(edges, sources, "key_a", "key_b")) == {("t", "g", 2), ("g", "g", 1)}


@pytest.mark.parametrize("most", [2, 5, 8, 11])
def test_close_pairs_are_all_and_once(spark, most):
    rng = random.Random(most)
    base = rng.getrandbits(64)
    hs = {signed(base)} | {signed(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 7)))) for _ in range(80)}
    want = {(min(a, b), max(a, b), d) for a, b in combinations(hs, 2) if (d := ((a ^ b) & (2**64 - 1)).bit_count()) <= most}
    df = spark.createDataFrame([(h,) for h in hs], "h bigint")
    assert rows(dedup.close_pairs(df, most)) == want
    for way in [(3, 1, 0), (4, 2, 0), (6, 4, 0)] if most <= 2 else [(4, 1, 1), (4, 2, 1)]:
        assert rows(dedup.close_pairs(df, most, way)) == want


def test_keys_get_wider_for_more_hashes():
    for most in (2, 8):
        work = [n * (2 * math.comb(b, p) * (1 + 64 // b * f) ** p + n * math.comb(b, p) * (1 + 64 // b * f) ** (2 * p) / 2.0 ** (64 * p // b)) for n in (10**4, 10**6, 10**8) for b, p, f in [dedup.plan(n, most)]]
        assert work[2] / work[0] < (10**4) ** 1.45


def test_unknown_source(spark):
    items, prio = spark.createDataFrame([("mystery",), ("a",)], "source string"), spark.createDataFrame([("a",)], "source string")
    with pytest.raises(checks.DataError, match="mystery"):
        checks.require_none(dedup.unknown_sources(items, prio), "unknown sources")


def test_hashes(spark):
    df = spark.createDataFrame([("Same words here", 0), ("here same WORDS", 1), (None, 2), ("", 3)], "t string, i int")
    got = {r["i"]: r["h"] for r in df.select("i", similarity_hash(F.col("t")).alias("h")).collect()}
    assert got[0] == got[1] != 0 and got[2] is None and got[3] == 0
    image = np.add.outer(np.arange(40), 2 * np.arange(60)).astype(np.uint8)
    brighter = (image // 2 + 60).astype(np.uint8)
    data = [(0, (40, 60, image.tobytes())), (1, (40, 60, brighter.tobytes())), (2, (40, 60, image[:, ::-1].tobytes())), (3, (4, 4, b"x")), (4, None)]
    df = spark.createDataFrame(data, "i int, image struct<h: int, w: int, data: binary>")
    got = {r["i"]: r["h"] for r in df.select("i", perceptual_hash(F.col("image")).alias("h")).collect()}
    near = lambda a, b: ((got[a] ^ got[b]) & (2**64 - 1)).bit_count()
    assert near(0, 1) < near(0, 2) and got[3] is None and got[4] is None


# ---- groups and splits


def test_components(spark):
    edges = [("b", "a"), ("b", "c"), ("x", "y"), ("y", "y"), (None, "q")] + [(f"n{i:03}", f"n{i + 1:03}") for i in range(70)]
    got = rows(graph.components(spark, spark.createDataFrame(edges, "key_a string, key_b string")))
    assert got == {("a", "a"), ("b", "a"), ("c", "a"), ("x", "x"), ("y", "x")} | {(f"n{i:03}", "n000") for i in range(71)}
    assert graph.components(spark, spark.createDataFrame([], "key_a string, key_b string")).count() == 0


def test_edges_leaving_the_pool_and_strata(spark):
    pool = spark.createDataFrame([("a", "s", "p"), ("b", "t", "p"), ("c", "t", "p"), ("d", "t", "p")], "key string, source string, class_name string")
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "out"), ("out", "d")], "key_a string, key_b string")
    grouped = graph.group_ids(spark, pool, edges)
    assert rows(grouped, "key", "group_id") == {("a", "a"), ("b", "a"), ("c", "a"), ("d", "d")}
    assert rows(graph.primary_stratum(grouped)) == {("a", "t", "p"), ("d", "t", "p")}


def pool(spark, *spec):
    return spark.createDataFrame([(f"{c}/{s}__{i:04}.png", c, s) for c, s, n in spec for i in range(n)], "key string, class_name string, source string")


EDGES = "key_a string, key_b string"


def replay_train_val(members, fraction, order):
    """The sequential rule, in a loop."""
    groups: dict = {}
    for g, s, c in members:
        groups.setdefault(g, []).append((s, c))
    sizes: dict = {}
    for _, s, c in members:
        sizes[s, c] = sizes.get((s, c), 0) + 1
    target = {k: int(n * fraction + 0.5) for k, n in sizes.items()}
    primary = {g: min(set(m), key=lambda x: (-m.count(x), x)) for g, m in groups.items()}
    val = dict.fromkeys(sizes, 0)
    out = {}
    for stratum in sorted(sizes):
        for g in order(stratum, [g for g in groups if primary[g] == stratum]):
            out[g] = "val" if val[stratum] < target[stratum] else "train"
            if out[g] == "val":
                for m in groups[g]:
                    val[m] += 1
    return out


def test_mixed_groups_couple_strata(spark):
    import hashlib

    rng = random.Random(9)
    members = [(f"g{rng.randrange(120):03}", rng.choice("stu"), rng.choice(["p", "q"])) for _ in range(400)]
    order = lambda st, gs: sorted(gs, key=lambda g: (hashlib.md5(f"42:split:{st[0]}:{st[1]}:{g}".encode()).hexdigest(), g))
    df = spark.createDataFrame(members, "group_id string, source string, class_name string")
    got = {r["group_id"]: r["split"] for r in split.train_val(spark, df, graph.primary_stratum(df), 0.3).collect()}
    assert got == replay_train_val(members, 0.3, order)


def test_groups_never_straddle_and_routes(spark):
    items = pool(spark, ("paper", "t", 30), ("paper", "g", 30), ("glass", "garbage", 12), ("glass", "real", 8))
    edges = spark.createDataFrame([("paper/t__0000.png", "paper/g__0000.png"), ("paper/g__0000.png", "paper/g__0001.png"), ("paper/t__0005.png", "paper/t__0006.png"), ("glass/real__0000.png", "paper/t__0009.png")], EDGES)
    got = split.split_items(spark, items, edges, "real", ["garbage"], fraction=0.3).collect()
    by = {r["key"]: (r["split"], r["group_id"]) for r in got}
    assert len(by) == len(got) == 80
    assert by["paper/t__0000.png"] == by["paper/g__0000.png"] == by["paper/g__0001.png"] and by["paper/g__0001.png"][1] == "paper/g__0000.png"
    count = lambda s: sum(v[0] == s for v in by.values())
    assert (count("test"), count("wild_test")) == (8, 12) and 18 <= count("val") <= 20
    assert all(g is None for s, g in by.values() if s in ("test", "wild_test"))


@pytest.mark.parametrize(("fraction", "val"), [(0.15, 15), (0.2, 20)])
def test_plain_fractions(spark, fraction, val):
    got = split.split_items(spark, pool(spark, ("metal", "t", 100)), spark.createDataFrame([], EDGES), None, fraction=fraction)
    assert got.where("split = 'val'").count() == val and got.count() == 100


def test_clean_holdout(spark):
    items = pool(spark, ("metal", "t", 40), ("metal", "g", 40))
    edges = spark.createDataFrame([("metal/t__0000.png", "metal/t__0001.png")], EDGES)
    got = split.split_items(spark, items, edges, None, clean_sources=["t"], clean_fraction=0.25).collect()
    clean = [r for r in got if r["split"] == "clean_test"]
    assert len({r["group_id"] for r in clean}) == 10 and {r["source"] for r in clean} == {"t"}


def test_refused_splits(spark):
    items, none = pool(spark, ("metal", "t", 4)), spark.createDataFrame([], EDGES)
    with pytest.raises(checks.DataError):
        split.split_items(spark, items, none, "gone")
    with pytest.raises(checks.DataError):
        split.split_items(spark, items, none, None, fraction=1.5)


# ---- balance


@pytest.mark.parametrize(
    ("pools", "cap", "want"),
    [
        ({"a": 50, "b": 30, "c": 20}, 60, {"a": 30, "b": 18, "c": 12}),
        ({"a": 1000, "b": 3}, 100, {"a": 99, "b": 1}),
        ({"a": 40}, 1500, {"a": 40}),
        ({"a": 100, "b": 1, "c": 1}, 3, {"a": 2, "b": 1, "c": 1}),
        ({"a": 7, "b": 7, "c": 7}, 11, {"a": 5, "b": 3, "c": 3}),
        ({"a": 5, "b": 5, "c": 5}, 2, {"a": 2, "b": 0, "c": 0}),
    ],
)
def test_allocation(spark, pools, cap, want):
    df = spark.createDataFrame([("x", s, n) for s, n in pools.items()], "class_name string, source string, size bigint")
    assert {r["source"]: r["take"] for r in balance.allocate(df, cap).collect()} == want


def test_balance(spark):
    items = pool(spark, ("glass", "real", 30), ("glass", "g", 50), ("paper", "g", 50), ("paper", "t", 50), ("organic", "g", 12))
    caps = spark.createDataFrame([("g", "paper", 5)], "source string, class_name string, source_cap int")
    got = balance.balance(items, 100, exempt=["real"], source_caps=caps)
    counts = {(r["class_name"], r["source"]): (r["kept"], r["dropped"]) for r in balance.balance_counts(got).collect()}
    assert counts == {("glass", "real"): (30, 0), ("glass", "g"): (50, 0), ("paper", "g"): (5, 45), ("paper", "t"): (50, 0), ("organic", "g"): (12, 0)}
    assert rows(balance.below_floor(got, 40)) == {("organic", 12)}
    assert rows(balance.balance(items.repartition(9), 100, exempt=["real"], source_caps=caps)) == rows(got)
    with pytest.raises(ValueError):
        balance.balance(items, 0)


def test_review_sample(spark):
    items = spark.createDataFrame([(f"{m}{i}", c, m) for (c, m), n in {(0, "x"): 20, (0, "y"): 10, (1, "x"): 6, (1, "y"): 4}.items() for i in range(n) for c in [c]], "key string, class_id int, method string")
    counts = balance.review_sample(items, ["class_id", "method"], 0.5).groupBy("class_id", "method").count()
    assert rows(counts) == {(0, "x", 10), (0, "y", 5), (1, "x", 3), (1, "y", 2)}


# ---- boxes and quality

BOX = "image string, class_id int, cx double, cy double, w double, h double"


def flags(spark, boxes, images=None):
    images = images or [(i, "dino", 0.9) for i in {b[0] for b in boxes}]
    got = qa.qa_flags(spark.createDataFrame(images, "image string, method string, confidence double"), spark.createDataFrame(boxes, BOX))
    return {r["image"]: r["flags"] for r in got.collect()}


def square(image, area, class_id=0):
    return (image, class_id, 0.5, 0.5, area**0.5, area**0.5)


def test_flags(spark):
    got = flags(spark, [square("two", 0.25), square("two", 0.25), square("tiny", 0.04), square("huge", 0.9604), square("fine", 0.25), ("edge", 1, 0.5, 0.7, 1.0, 0.6), ("ok", 1, 0.5, 0.5, 1.0, 0.5)], [("two", "dino", 0.9), ("tiny", "dino", 0.29), ("huge", "dino", 0.3), ("fine", "centerbox", None), ("edge", "dino", 1.0), ("ok", "dino", 1.0), ("none", "dino", 0.5)])
    assert got == {"two": ["box_count"], "tiny": ["area_extreme", "low_confidence"], "huge": ["area_extreme"], "fine": ["centerbox"], "edge": ["edge_contact"], "ok": [], "none": ["box_count"]}


def test_outliers(spark):
    got = flags(spark, [square(f"i{k}", a) for k, a in enumerate([0.2] * 9 + [0.21, 0.9])])
    assert [i for i, f in got.items() if f] == ["i10"] and got["i10"] == ["area_zscore"]
    got = flags(spark, [(f"i{k}", 0, 0.5, 0.5, 0.3 * r**0.5, 0.3 / r**0.5) for k, r in enumerate([1.0] * 9 + [1.05, 5.0])])
    assert {i: f for i, f in got.items() if f} == {"i10": ["aspect_zscore"]}
    assert not any(flags(spark, [square("a", 0.3), square("b", 0.3), square("c", 0.4, 1)]).values())


def test_overlap_by_hand(spark):
    one = lambda *b: spark.createDataFrame([("i", 0, *b)], BOX)
    got = qa.best_overlaps(one(0.4, 0.4, 0.4, 0.4), one(0.5, 0.4, 0.4, 0.4)).first()["iou"]
    assert got == pytest.approx(0.6)
    assert qa.best_overlaps(one(0.5, 0.5, 0.5, 0.25), one(0.5, 0.5, 0.25, 0.5)).first()["iou"] == pytest.approx(1 / 3)
    assert qa.best_overlaps(one(0.1, 0.1, 0.1, 0.1), one(0.9, 0.9, 0.1, 0.1)).first()["iou"] == 0
    stats = qa.overlap_stats(spark.createDataFrame([(1.0,), (1 / 3,), (0.0,)], "iou double")).first()
    assert [round(stats[c], 6) for c in ("q1", "median", "q3", "frac_good")] == [round(x, 6) for x in (1 / 6, 1 / 3, 2 / 3, 1 / 3)]


@pytest.mark.parametrize(("figures", "want"), [((0.1, 0.2, 0.8), "pass"), ((0.11, 0.2, 0.8), "fail"), ((None, 0.2, 0.8), "pending")])
def test_gate(spark, figures, want):
    df = spark.createDataFrame([figures], "a double, b double, c double")
    assert df.select(qa.gate(F.col("a"), F.col("b"), F.col("c"))).first()[0] == want


@pytest.mark.parametrize(
    ("method", "confidence", "label", "known", "want"),
    [
        ("centerbox", 0.1, "0 .5 .5 1 1", True, "method"), ("dino", 0.29, None, True, "low_confidence"), ("dino", 0.30, "0 .5 .5 1 .92", True, None), ("dino", 0.9, "0 .5 .5 1 .93", True, "box_too_large"),
        ("dino", 0.9, "0 .5 .5 .05 .05", True, "box_too_small"), ("dino", 0.9, "0 .5 .5 .05 .1", True, None), (None, None, "0 .5 .5 1 1", False, "box_too_large"), ("dino", 0.9, "0 .5 x 1 1", True, None),
        ("birefnet", None, "0 .5 .5 .5 .5", True, "low_confidence"), ("dino", 0.9, "", True, None), (None, None, None, False, None),
    ],
)
def test_quality_filter(spark, method, confidence, label, known, want):
    items = spark.createDataFrame([("i", "k", label)], "ident string, key string, label_text string")
    prov = spark.createDataFrame([("i", method, confidence)] if known else [], "ident string, method string, confidence double")
    assert rows(quality.quality_filter(items, prov)) == {("k", want)}


def test_label_lines(spark):
    text = "﻿0 0.5 0.5 0.2 0.2\r\n\n 1 0.1 0.2 0.3 1.5\n2 1 1 1\nx 1 1 1 1\n-1 0 0 0 0\n3 1e-1 0 1 nan"
    got = bx.boxes_table(spark.createDataFrame([("i", text), ("n", None), ("e", "")], "image string, label_text string")).collect()
    assert [(r["pos"], r["ok"]) for r in sorted(got, key=lambda r: r["pos"])] == [(0, True), (1, False), (2, False), (3, False), (4, False), (5, False)]


def test_proposals_masks_and_centre(spark):
    props = spark.createDataFrame([("a", 0, 10.0, 20.0, 60.0, 80.0, 0.4), ("a", 1, 50.0, 20.0, 150.0, 80.0, 0.8), ("b", 0, 0.0, 0.0, 9.0, 9.0, 0.4), ("c", 0, 1.0, 1.0, 5.0, 5.0, 0.9), ("c", 1, 2.0, 2.0, 5.0, 5.0, 0.9)], "image string, pos int, x1 double, y1 double, x2 double, y2 double, confidence double")
    mask = np.zeros((80, 100), np.uint8)
    mask[20:60, 10:50] = 200
    mask[0:3, 90:95] = 255
    mask[0:80, 96:100] = 127  # no foreground
    full = np.full((80, 100), 255, np.uint8)
    thin = np.zeros((80, 100), np.uint8)
    thin[0, :], thin[:, 0] = 255, 255  # its box is the whole image, its pixels are not
    masks = spark.createDataFrame([("b", (80, 100, mask.tobytes())), ("d", (80, 100, full.tobytes())), ("e", (80, 100, bytes(8000))), ("f", (80, 100, thin.tobytes()))], "image string, mask struct<h: int, w: int, data: binary>")
    boxed = masks.select("image", autobox.mask_box(F.col("mask")).alias("box")).withColumn("mask_area", F.col("box.area"))
    images = spark.createDataFrame([(i, 200 if i == "a" else 100, 100 if i == "a" else 80) for i in "abcdef"], "image string, width int, height int")
    got = {r["image"]: r for r in autobox.chain(images, autobox.best_proposal(props, 0.5), boxed).collect()}
    assert (got["a"]["method"], tuple(got["a"]["box"]), got["a"]["confidence"], got["a"]["flags"]) == ("dino", (50.0, 20.0, 150.0, 80.0), 0.8, ["multibox"])
    assert (got["b"]["method"], tuple(got["b"]["box"]), got["b"]["confidence"], got["b"]["flags"]) == ("birefnet", (10.0, 20.0, 50.0, 60.0), None, [])
    assert tuple(got["c"]["box"]) == (1.0, 1.0, 5.0, 5.0)
    assert {got[i]["method"] for i in "def"} == {"centerbox"} and got["d"]["flags"] == ["centerbox"]
    line = spark.createDataFrame([(50.0, 20.0, 150.0, 80.0)], "a double, b double, c double, d double").select(bx.label_line(F.lit(0), tuple(F.col(x) for x in "abcd"), F.lit(200), F.lit(100))).first()[0]
    assert line == "0 0.500000 0.500000 0.500000 0.600000"


def flood(mask):
    seen, best = np.zeros(mask.shape, bool), None
    for y, x in zip(*np.nonzero(mask), strict=True):
        if seen[y, x]:
            continue
        stack, part = [(y, x)], []
        seen[y, x] = True
        while stack:
            a, b = stack.pop()
            part.append((a, b))
            for c, d in ((a + 1, b), (a - 1, b), (a, b + 1), (a, b - 1)):
                if 0 <= c < mask.shape[0] and 0 <= d < mask.shape[1] and mask[c, d] and not seen[c, d]:
                    seen[c, d] = True
                    stack.append((c, d))
        if best is None or len(part) > len(best):
            best = part
    ys, xs = zip(*best, strict=True)
    return min(xs), min(ys), max(xs) + 1, max(ys) + 1, len(best)


@pytest.mark.parametrize("seed", range(8))
def test_largest_part(seed):
    mask = np.random.default_rng(seed).random((13, 17)) < 0.55
    assert autobox.largest_part(mask) == flood(mask)


# ---- remap

SPECS = "source string, mapping map<string,string>, drops array<string>"


@pytest.fixture
def specs(spark):
    return spark.createDataFrame([("s", {"plastic": "plastic", "Paper": "paper", "AluCan": "metal", "Glass": "glass", "PET": "plastic"}, ["trash", "CLOTH"])], SPECS)


def test_routing(spark, specs):
    paths = [("plastic/a.jpg", "plastic"), ("Paper/b.PNG", "paper"), ("trash/c.jpg", "DROP"), ("train/Plastic/images/a.jpg", "plastic"), ("plastic/paper/x.jpg", "paper"), (".plastic/y.jpg", None), ("rubber/images/b.jpg", None), ("x.jpg", None)]
    got = remap.route(spark.createDataFrame([(p, "s") for p, _ in paths], "path string, source string"), remap.label_map(specs))
    assert rows(got, "path", "target") == set(paths)
    assert rows(remap.unmapped(got), "path") == {(p,) for p, t in paths if t is None}


def test_clashing_labels(spark):
    with pytest.raises(checks.DataError):
        remap.label_map(spark.createDataFrame([("s", {"Can": "metal", "can": "glass"}, [])], SPECS))


def test_label_rewrite(spark, specs):
    names = spark.createDataFrame([("s", i, n) for i, n in enumerate(["alucan", "glass", "pet", "cloth"])], "source string, idx int, label string")
    classes = spark.createDataFrame([("plastic", 0), ("metal", 3), ("glass", 4)], "target string, class_id int")
    labels = spark.createDataFrame([("i", "s", "0 .5 .5 .2 .2\n2 .1 .2 .3 .4\n3 .1 .1 .1 .1\n3 0 0 0 0"), ("w", "s", "3 0 0 0 0"), ("b", "s", "9 0 0 0 0\nx 1")], "image string, source string, label_text string")
    rw = remap.rewritten_lines(labels, names, remap.label_map(specs), classes)
    assert {r["image"]: (r["label_text"], r["kept"], r["dropped"]) for r in remap.rewritten_labels(rw).collect()} == {"i": ("3 .5 .5 .2 .2\n0 .1 .2 .3 .4", 2, 2), "w": ("", 0, 1), "b": ("", 0, 0)}
    assert rows(remap.majority_target(rw.where("image <> 'b'"))) == {("i", "metal"), ("w", "wilderness")}
    assert rows(remap.bad_lines(rw)) == {("b", 0), ("b", 1)}


def test_destinations(spark):
    files = spark.createDataFrame([("train/x.jpg", "src", "p"), ("val/x.jpg", "src", "p"), ("val/x.png", "src", "q"), ("y", "src", "p")], "path string, source string, target string")
    assert rows(remap.destination_names(files)) == {("train/x.jpg", "p/src__x.jpg"), ("val/x.jpg", "p/src__x__1.jpg"), ("val/x.png", "q/src__x.png"), ("y", "p/src__y")}


def test_destinations_never_meet(spark):
    paths = [f"{d}/{stem}.jpg" for d, stem in (("1", "a"), ("2", "a"), ("3", "a"), ("4", "a"), ("1", "a__1"), ("2", "a__1"), ("1", "a__3"), ("1", "a__1__1"), ("1", "a__01"))]
    got = rows(remap.destination_names(spark.createDataFrame([(p, "s", "t") for p in paths], "path string, source string, target string")))
    assert {p: d.removeprefix("t/s__").removesuffix(".jpg") for p, d in got} == {
        "1/a.jpg": "a", "2/a.jpg": "a__2", "3/a.jpg": "a__4", "4/a.jpg": "a__5", "1/a__1.jpg": "a__1", "2/a__1.jpg": "a__1__2", "1/a__3.jpg": "a__3", "1/a__1__1.jpg": "a__1__1", "1/a__01.jpg": "a__01",
    }
    assert len({d for _, d in got}) == len(paths)


def test_label_lookup(spark):
    images = spark.createDataFrame([("a/images/x.jpg",), ("a/images/y.jpg",), ("images/b/images/z.jpg",), ("q.jpg",)], "image string")
    files = spark.createDataFrame([("a/images/x.txt",), ("a/labels/x.txt",), ("a/labels/y.txt",), ("images/b/labels/z.txt",), ("labels/b/images/z.txt",)], "path string")
    assert rows(remap.label_files(images, files)) == {("a/images/x.jpg", "a/images/x.txt"), ("a/images/y.jpg", "a/labels/y.txt"), ("images/b/images/z.jpg", "images/b/labels/z.txt"), ("q.jpg", None)}


def test_manifest_counts(spark):
    df = spark.createDataFrame([({" Paper": 1, "paper": 2, "METAL ": None, "shoes": 4},)], "c map<string,int>")
    assert df.select(remap.manifest_class_counts(F.col("c"))).first()[0] == {"metal": 0, "paper": 3, "shoes": 4}


def test_report_tables():
    assert reports.latex_escape(r"a_b & 5% \x") == r"a\_b \& 5\% \textbackslash{}x"
    assert r"a\_b & 1 \\" in reports.latex_table([("a_b", 1)], ["n", "k"], "lr")


def test_spread_ranks_equal_a_window(spark):
    from pyspark.sql import Window

    from siftlane.functions.ranking import place, running_sum

    df = spark.range(3000).select((F.col("id") % 3 % 2).alias("g"), F.col("id").cast("string").alias("key"), (F.col("id") % 7).alias("n"))
    digest = F.md5("key")
    got = rows(place(df, ["g"], digest, "key"), "g", "key", "place")
    assert got == rows(df.withColumn("place", F.row_number().over(Window.partitionBy("g").orderBy(digest))), "g", "key", "place")
    before = Window.partitionBy("g").orderBy(digest).rowsBetween(Window.unboundedPreceding, -1)
    assert rows(running_sum(df, ["g"], digest, "key", F.col("n"), "s"), "key", "s") == rows(df.withColumn("s", F.coalesce(F.sum("n").over(before), F.lit(0))), "key", "s")
    assert place(df.where("false"), ["g"], digest, "key").count() == 0


def test_picks_of_the_python_generator(spark):
    items = pool(spark, ("paper", "s", 30), ("paper", "t", 10), ("glass", "s", 3))
    got = {r["key"] for r in balance.balance(items, 20, seed=7, generator="twister").where("kept").collect()}
    keys = sorted(f"paper/s__{i:04}.png" for i in range(30))
    other = sorted(f"paper/t__{i:04}.png" for i in range(10))
    want = set(random.Random("7:cap:paper:s").sample(keys, 15)) | set(random.Random("7:cap:paper:t").sample(other, 5)) | {f"glass/s__{i:04}.png" for i in range(3)}
    assert got == want


def test_orders_of_the_python_generator(spark):
    rng = random.Random(9)
    members = [(f"g{rng.randrange(90):03}", rng.choice("st"), rng.choice(["p", "q"])) for _ in range(300)]

    def order(stratum, groups):
        groups = sorted(groups)
        random.Random(f"42:split:{stratum[0]}:{stratum[1]}").shuffle(groups)
        return groups

    df = spark.createDataFrame(members, "group_id string, source string, class_name string")
    strata = graph.primary_stratum(df)
    got = {r["group_id"]: r["split"] for r in split.train_val(spark, df, strata, 0.25, generator="twister").collect()}
    assert got == replay_train_val(members, 0.25, order)
    clean = {r["group_id"] for r in split.clean_holdout(strata, ["s"], 0.5, 42, "twister").collect()}
    want = set()
    for c in "pq":
        gs = sorted(r["group_id"] for r in strata.where(f"source = 's' AND class_name = '{c}'").collect())
        random.Random(f"42:clean_holdout:s:{c}").shuffle(gs)
        want |= set(gs[: int(len(gs) * 0.5 + 0.5)])
    assert clean == want
