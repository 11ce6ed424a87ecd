from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pytest

from siftlane.__main__ import main
from siftlane.functions import degrade as dg
from siftlane.operators import consensus
from siftlane.plans.build import BuildConfig, build
from siftlane.sources import artifacts
from siftlane.sources.registry import ConfigError
from siftlane.streaming.decisions import windowed_tallies
from tests.conftest import SF, rows


def test_degradation_is_deterministic_and_grows():
    image = np.random.default_rng(1).integers(0, 255, (40, 50, 3)).astype(np.uint8)
    loss = []
    for s in dg.SEVERITIES:
        one = dg.degrade(image, s, 7)
        assert one.shape == image.shape and one.dtype == np.uint8 and (one == dg.degrade(image, s, 7)).all()
        loss.append(np.abs(one.astype(float) - image).mean())
    assert loss[4] > loss[0]
    assert (dg.degrade(image, 3, 7) != dg.degrade(image, 3, 8)).any()
    for bad in ((image[..., 0], 1, 1), (image, 6, 1), (image, 1, -1), (image.astype(float), 1, 1)):
        with pytest.raises(ValueError):
            dg.degrade(*bad)


def test_flat_image_keeps_its_mean():
    flat = np.full((30, 30, 3), 120, np.uint8)
    assert np.allclose(dg.lose_resolution(dg.line_blur(flat, 5, 0.3), 5), 120)


def test_degraded_tiers(spark):
    image = np.zeros((4, 5, 3), np.uint8)
    df = spark.createDataFrame([("a", 4, 5, image.tobytes()), ("b", 4, 5, b"x"), ("c", 1, 1, None)], "image string, h int, w int, data binary")
    got = {(r["image"], r["severity"]): r["data"] for r in dg.degraded_tiers(df, (1, 5)).collect()}
    assert len(got) == 6 and bytes(got["a", 5]) == dg.degrade(image, 5, 42).tobytes() and got["b", 1] is None is got["c", 1]


def test_threshold_file(tmp_path, spark):
    cell = {"tau_frame": 0.4, "min_votes": 3, "high_water": 0.6, "wrong_bin_rate": 0.01, "rest_rate": 0.2}
    artifacts.write_thresholds(cell, 0.25, True, tmp_path / "t.yaml", {0: 0.3, 1: 0.5})
    assert artifacts.read_thresholds(tmp_path / "t.yaml")["tau_frame"] == {0: 0.3, 1: 0.5}
    good = "tau_frame: 0.4\nmin_votes: 3\nhigh_water: 0.6\nconf_floor: 0.25\n"
    for text in (good + "x: 1\n", good.replace("min_votes: 3", "min_votes: 0"), good.replace("0.6", "high"), good.replace("0.4", "{}"), good.replace("0.4", '{"0": 0.4}'), good.replace("conf_floor: 0.25\n", ""), "- 1\n"):
        (tmp_path / "t.yaml").write_text(text)
        with pytest.raises(ConfigError):
            artifacts.read_thresholds(tmp_path / "t.yaml")
    with pytest.raises(ConfigError):
        artifacts.read_thresholds(tmp_path / "none.yaml")
    (tmp_path / "t.yaml").write_text(good.replace("0.6", "1.6"))
    assert artifacts.read_thresholds(tmp_path / "t.yaml")["high_water"] == 1.6
    swept = spark.createDataFrame([(1, 0.5, 2, 0.6, 0.0, 0.1), (0, 0.4, 2, 0.6, 0.1, 0.0)], "cell_idx int, tau_mean double, min_votes int, high_water double, wrong_bin_rate double, rest_rate double")
    artifacts.write_sweep(swept, 1, tmp_path / "s.csv")
    assert (tmp_path / "s.csv").read_text().splitlines()[1:] == ["0.4,2,0.6,0.1,0.0,0", "0.5,2,0.6,0.0,0.1,1"]
    from siftlane.sources.readers import read_sweep

    assert read_sweep(spark, str(tmp_path / "s.csv")).count() == 2


def test_report_table(spark, tmp_path):
    tier = {"tier": "val", "split": "val", "severity": 0, "per_class": {"paper": {"precision": 1, "recall": 0.5, "map50": 0.7, "map50_95": 0.6, "conf_at_p95": None}}}
    got = artifacts.report_table(spark, {"val": tier, "test1": tier | {"tier": "test1"}, "test2": [tier | {"tier": "test2_s1", "severity": 1}], "clean": None})
    assert rows(got, "tier", "severity", "precision", "conf_at_p95") == {("val", 0, 1.0, None), ("test1", 0, 1.0, None), ("test2_s1", 1, 1.0, None)}
    with pytest.raises(ConfigError):
        artifacts.report_table(spark, {})
    (tmp_path / "m.yaml").write_text("source: s\n")
    with pytest.raises(ConfigError):
        artifacts.read_remap_manifest(tmp_path / "m.yaml")


def test_streamed_consensus(spark, tmp_path):
    t = datetime(2025, 1, 1, 10)
    data = [("o", f"i{k}", 1, 2, 0.9, t + timedelta(minutes=k)) for k in range(4)] + [("o", "late", 1, 3, 0.9, t - timedelta(days=9)), ("o", "end", 1, 3, 0.9, t + timedelta(days=3)), ("o", "none", 1, 3, 0.9, None), ("o", "clean", 0, 3, 0.9, t)]
    schema = "object string, image_id string, severity int, class_id int, score double, logged_at timestamp_ntz"
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    q = windowed_tallies(stream, 0.5).writeStream.outputMode("append").format("memory").queryName("tallies").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = consensus.decide(spark.table("tallies"), 3, 0.6)
    assert ("o", 2) in rows(got, "object", "decision")


def test_build_resumes(spark, tmp_path):
    said: list[str] = []
    config = BuildConfig(cap=30, leave_out="quaybelt", wild=("milltray",))
    assert build(spark, SF, str(tmp_path), config, say=said.append) == ["items", "quality", "balance", "split"]
    assert build(spark, SF, str(tmp_path), config, say=said.append) == []
    assert build(spark, SF, str(tmp_path), config, only="split", force=True, say=said.append) == ["split"]
    assert build(spark, SF, str(tmp_path), BuildConfig(cap=31), say=said.append) == ["items", "quality", "balance", "split"]
    df = spark.read.parquet(str(tmp_path / "split"))
    assert df.count() == spark.read.parquet(str(tmp_path / "balance")).where("kept").count() > 0


def test_command_line(spark, tmp_path):
    assert main(["query", "so4_repeated", "--data", SF, "--out", str(tmp_path / "q")]) == 0
    assert spark.read.parquet(str(tmp_path / "q")).columns == ["key"]
    assert main(["query", "nothing", "--data", SF]) == 2
    assert main(["query", "so4_repeated", "--data", "/nowhere"]) == 1
    assert main(["compact", "--files", f"{SF}/item_files.parquet", "--items", f"{SF}/items.parquet", "--out", str(tmp_path / "c")]) == 0
    assert spark.read.parquet(str(tmp_path / "c/records")).count() > 0


def test_scratch_can_be_cleared(spark):
    from siftlane.session import Scratch, clear_scratch

    kept = Scratch(spark, "t").keep(spark.range(3), "x")
    assert kept.count() == 3
    clear_scratch(spark)
    with pytest.raises(Exception):  # noqa: B017
        kept.count()


def test_a_cluster_must_name_a_shared_folder():
    from types import SimpleNamespace

    from siftlane.session import checkpoint_root

    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="checkpoint"):
        checkpoint_root(bare)
