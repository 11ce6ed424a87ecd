"""Consensus, sweep, choice, calibration, curves; expected values worked out by hand."""

from __future__ import annotations

import math
import random

import pytest

from siftlane.operators import calibrate, consensus, evaluate, sweep
from tests.conftest import rows

DET = "object string, image_id string, class_id int, score double, severity int"


def votes(spark, spec, obj="o"):
    """One frame per vote."""
    return spark.createDataFrame([(obj, f"i{k}", c, s, 1) for k, (c, s) in enumerate(spec)], DET)


def taus(spark, tau=0.4):
    return spark.createDataFrame([(0.0, c, tau) for c in range(6)], "cell double, class_id int, tau double")


@pytest.mark.parametrize(
    ("spec", "water", "want"),
    [
        ([(1, 0.9), (0, 0.1), (2, 0.2)], 0.6, None),
        ([(0, 0.7)] * 3 + [(1, 0.7)] * 3, 0.6, None),
        ([(0, 0.7)] * 4 + [(1, 0.7)] * 3, 0.6, 0),
        ([(0, 0.55)] * 5, 0.60, None),
        ([(0, 0.55)] * 5, 0.55, 0),
        ([(5, 0.9)] * 4, 0.6, 5),
    ],
)
def test_decision(spark, spec, water, want):
    got = consensus.decide(consensus.tally(votes(spark, spec), taus(spark)), 3, water)
    assert rows(got, "object", "decision") == {("o", want)}


def test_top_frames(spark):
    df = spark.createDataFrame([("o", "a", 2, 0.9, 0), ("o", "a", 1, 0.9, 0), ("o", "a", 0, 0.2, 0), ("o", "a", 3, 0.1, 1)], DET)
    assert rows(consensus.top_frames(df)) == {("o", "a", 0, 1, 0.9), ("o", "a", 1, 3, 0.1)}
    df = spark.createDataFrame([("o", "a.jpg", 0, s, 0) for s in (0.2, 0.9, 0.5)] + [("p", "b.jpg", 0, 0.4, 0)], DET)
    assert rows(consensus.top_scores(df), "image_id", "score") == {("a.jpg", 0.9), ("b.jpg", 0.4)}


def test_silent_objects_rest(spark):
    truth = spark.createDataFrame([("o", 0), ("quiet", 1)], "object string, class_id int")
    decided = consensus.decide(consensus.tally(votes(spark, [(0, 0.9)] * 3), taus(spark)), 3, 0.6)
    assert rows(consensus.with_silent(truth, decided), "object", "decision") == {("o", 0), ("quiet", None)}


def test_mixed_groups_are_marked(spark):
    df = spark.createDataFrame([("g", 1), ("g", 1), ("h", 1), ("h", 2)], "object string, class_id int")
    assert rows(consensus.group_truth(df)) == {("g", 1, False), ("h", 1, True)}


def test_sightings(spark):
    df = spark.createDataFrame([(f"o{k}", f"i{j}", j % 6, 0.5, int(k > 0) * (j % 3)) for k in range(20) for j in range(6)], DET)
    got = consensus.sightings(df).collect()
    per = {}
    for r in got:
        per.setdefault(r["object"], []).append(r["draw"])
    assert len(per) == 20 and all(sorted(d) == list(range(1, len(d) + 1)) and 5 <= len(d) <= 15 for d in per.values())
    assert {r["class_id"] for r in got if r["object"] != "o0"} <= {1, 2, 4, 5}  # degraded frames only
    assert rows(consensus.sightings(df.repartition(7))) == {tuple(r) for r in got}


def test_planted_grid(spark):
    """Five known objects strong, three weak, one unseen, two unknown ones weak: the feasible cell with least rest is (.6, 3, .5)."""
    spec = [(f"s{i}", c, 0.65) for i in range(5) for c in [i % 3] * 4] + [(f"w{i}", c, 0.55) for i in range(3) for c in [i] * 4] + [(f"x{i}", 0, 0.55) for i in range(2) for _ in range(4)]
    v = spark.createDataFrame([(o, f"{o}-{k}", c, s, 1) for k, (o, c, s) in enumerate(spec)], DET)
    truth = spark.createDataFrame([(f"s{i}", i % 3) for i in range(5)] + [(f"w{i}", i) for i in range(3)] + [("unseen", 0), ("x0", None), ("x1", None)], "object string, class_id int")
    cells = sweep.grid(spark, [0.4, 0.6], [3], [0.5, 0.7])
    all_taus = spark.createDataFrame([(t, c, t) for t in (0.4, 0.6) for c in range(6)], "tau_frame double, class_id int, tau double")
    swept = sweep.sweep(v, truth, cells, all_taus)
    got = {(r["tau_frame"], r["high_water"]): (r["wrong_bin_rate"], r["rest_rate"]) for r in swept.collect()}
    assert got[0.4, 0.5] == (pytest.approx(2 / 11), pytest.approx(1 / 9))
    assert got[0.6, 0.5] == (0.0, pytest.approx(4 / 9))
    best = sweep.choose(swept).collect()
    assert len(best) == 1 and (best[0]["tau_frame"], best[0]["high_water"], best[0]["feasible"]) == (0.6, 0.5, True)


def test_no_feasible_cell(spark):
    cells = spark.createDataFrame([(0, 0.5, 0.1), (1, 0.3, 0.4), (2, 0.3, 0.2)], "cell_idx int, wrong_bin_rate double, rest_rate double")
    assert rows(sweep.choose(cells), "cell_idx", "feasible") == {(2, False)}


def test_fronts(spark):
    cells = spark.createDataFrame([(0, 0.05, 0.01), (1, 0.01, 0.10), (2, 0.03, 0.05), (3, 0.03, 0.20), (4, 0.03, 0.05)], "cell_idx int, wrong_bin_rate double, rest_rate double")
    assert {r["cell_idx"] for r in sweep.front(cells).collect()} == {0, 1, 2, 4}  # equals stay
    assert {r["cell_idx"] for r in sweep.skyline(cells).collect()} == {0, 1, 2}  # one of them


def test_anchors(spark):
    points = spark.createDataFrame([(0, 0.30), (1, 0.55), (2, None), (3, 0.40), (4, 0.1)], "class_id int, conf double")
    got = {r["class_id"]: (r["anchor"], r["per_class"]) for r in sweep.per_class_anchors(points).collect()}
    assert got == {0: (0.30, True), 1: (0.55, True), 2: (0.6, True), 3: (0.4, True), 4: (0.3, True)}
    near = spark.createDataFrame([(0, 0.40), (1, 0.45)], "class_id int, conf double")
    anchors = sweep.per_class_anchors(near)
    assert {r["per_class"] for r in anchors.collect()} == {False}
    cells = sweep.grid(spark, [0.5], [2], [0.5])
    assert {r["tau"] for r in sweep.cell_taus(cells, anchors).collect()} == {0.5}
    spread = sweep.cell_taus(cells, sweep.per_class_anchors(points.where("class_id < 2")))
    assert {r["class_id"]: round(r["tau"], 6) for r in spread.collect()} == {0: 0.375, 1: 0.6}


def test_ece_bins_close_left(spark):
    df = spark.createDataFrame([(1.0, 1.0), (14 / 15, 1.0), (0.0, 0.0)], "score double, label double")
    assert rows(calibrate.calibration_bins(df), "bin", "n") == {(0, 1), (14, 2)}
    assert calibrate.calibration_error(df).first()["ece"] == pytest.approx((2 * abs((1 + 14 / 15) / 2 - 1)) / 3)


def test_temperature_is_recovered(spark):
    rng = random.Random(42)
    pairs = []
    for _ in range(6000):
        p = rng.uniform(0.02, 0.98)
        pairs.append((1 / (1 + math.exp(-2.5 * math.log(p / (1 - p)))), float(rng.random() < p)))
    df = spark.createDataFrame(pairs, "score double, label double").cache()
    t = calibrate.fit_temperature(df)
    assert abs(t / 2.5 - 1) < 0.15
    fixed = df.select(calibrate.with_temperature(df.score, t).alias("score"), "label")
    assert calibrate.calibration_error(fixed).first()["ece"] < calibrate.calibration_error(df).first()["ece"] / 2
    assert abs(calibrate.fit_temperature(fixed) - 1) < 0.2
    with pytest.raises(ValueError):
        calibrate.fit_temperature(df.where("false"))


def test_invalid_pairs(spark):
    df = spark.createDataFrame([(None, 1.0), (float("nan"), 0.0), (1.5, 0.5), (-0.1, None), (0.5, 1.0)], "score double, label double")
    assert tuple(calibrate.invalid_pairs(df).first()) == (2, 2, 2)


@pytest.mark.parametrize(
    ("precision", "want"),
    [([0.9] * 7 + [0.96] * 4, 0.7), ([0.96] * 11, 0.0), ([0.96] * 10 + [0.9], None), ([0.5, 0.99, 0.5] + [0.99] * 8, 0.3)],
)
def test_sustained_precision(spark, precision, want):
    curve = spark.createDataFrame([(0, i, i / 10, p) for i, p in enumerate(precision)], "class_id int, idx int, confidence double, precision double")
    got = evaluate.sustained_confidence(curve).first()["conf"]
    assert got == (None if want is None else pytest.approx(want))


def test_curve_equals_direct_counts(spark):
    rng = random.Random(1)
    data = [(c, round(rng.random(), 3), rng.random() < 0.6) for _ in range(300) for c in (0, 1)]
    for r in evaluate.precision_curve(spark.createDataFrame(data, "class_id int, score double, correct boolean"), 11).collect():
        above = [k for c, s, k in data if c == r["class_id"] and s >= r["confidence"] - 1e-12]
        assert r["precision"] == pytest.approx(sum(above) / len(above) if above else 1.0)
        assert r["recall"] == pytest.approx(sum(above) / sum(k for c, _, k in data if c == r["class_id"]))


def test_escalation(spark):
    m = spark.createDataFrame([("paper", 0.9, 0.69), ("metal", 0.9, 0.9)], "class_name string, map50 double, recall double")
    classes = spark.createDataFrame([("paper",), ("metal",), ("glass",)], "class_name string")
    assert rows(evaluate.escalation(m, classes, 0.9)) == {("paper", 0.9, 0.69, False, False), ("metal", 0.9, 0.9, True, False), ("glass", None, None, False, False)}
    good = m.where("class_name = 'metal'")
    one = classes.where("class_name = 'metal'")
    assert [evaluate.escalation(good, one, o).first()["all_passed"] for o in (0.8, 0.799)] == [True, False]


def test_small_choices(spark):
    tiers = spark.createDataFrame([("val", 1), ("test", 2)], "tier string, n int")
    assert rows(evaluate.headline(tiers)) == {("val", 1)}
    assert rows(evaluate.headline(tiers.union(spark.createDataFrame([("clean_test", 3)], "tier string, n int")))) == {("clean_test", 3)}
    points, clean = spark.createDataFrame([(1, 0.5), (0, 0.7)], "severity int, value double"), spark.createDataFrame([(0, 0.9)], "severity int, value double")
    assert rows(evaluate.severity_curve(points, clean)) == {(0, 0.7), (1, 0.5)}
    assert rows(evaluate.worst_tier(points)) == {(1, 0.5)}
    assert evaluate.best_epoch(spark.createDataFrame([(2, 0.5), (1, 0.5), (3, None)], "epoch int, m double"), "m").first()["epoch"] == 1
    runs = spark.createDataFrame([("a", 5, -1), ("b", 4, 0), ("c", 3, 9)], "run_id string, mtime int, epoch int")
    assert evaluate.resumable_run(runs).first()["run_id"] == "b"
    dens = evaluate.density(spark.createDataFrame([(1.0,), (0.0,), (0.01,)], "score double")).collect()
    assert len(dens) == 40 and sum(r["density"] for r in dens) / 40 == pytest.approx(1)


def test_interpolation(spark):
    curve = spark.createDataFrame([(0, 0, 0.0, 0.2), (0, 1, 0.5, 0.6), (0, 2, 1.0, 1.0)], "class_id int, idx int, confidence double, precision double")
    at = spark.createDataFrame([(0, 0.25), (0, 1.0)], "class_id int, conf double")
    assert rows(evaluate.interpolate(curve, at)) == {(0, 0.25, 0.4), (0, 1.0, 1.0)}


def test_tiers_and_curves(spark):
    tiers = spark.createDataFrame([("val", 0, "paper", 0.9), ("test1", 0, "glass", 0.8), ("test2_s1", 1, "paper", 0.7), ("test2_s5", 5, "paper", 0.5), ("wild", 0, "paper", 0.1)], "tier string, severity int, class_name string, map50 double")
    classes = spark.createDataFrame([("paper",), ("glass",)], "class_name string")
    assert rows(evaluate.tier_comparison(tiers, classes)) == {("val", "paper", 0.9), ("val", "glass", 0.0), ("test1", "paper", 0.0), ("test1", "glass", 0.8), ("test2_s5", "paper", 0.5), ("test2_s5", "glass", 0.0)}
    curves = spark.createDataFrame([("val", "a", i) for i in range(3)] + [("val", "b", i) for i in range(3)] + [("val", "c", i) for i in range(2)], "tier string, class_name string, idx int")
    assert rows(evaluate.uneven_curves(curves)) == {("val", "c", 2)}
    got = evaluate.tier_curves(tiers.select("tier").distinct(), spark.createDataFrame([("val",), ("test1",)], "curve string"))
    assert rows(got.where("tier <> 'wild'")) == {("val", "val"), ("test1", "test1"), ("test2_s1", "val"), ("test2_s5", "val")}


def test_a_class_without_a_threshold_is_an_error(spark):
    votes = spark.createDataFrame([("o", 1, 0.9), ("o", 7, 0.8)], "object string, class_id int, score double")
    tau = spark.createDataFrame([(0, 1, 0.5)], "cell int, class_id int, tau double")
    with pytest.raises(Exception, match="no threshold for class 7"):
        consensus.tally(votes, tau).collect()
    assert consensus.tally(votes.where("class_id = 1"), tau).count() == 1
