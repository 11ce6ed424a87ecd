"""The build's steps before balancing: remap, boxes, the QA gate, duplicates."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from siftlane.plans import views
from siftlane.plans.build import BuildConfig, build
from siftlane.plans.pipeline import Halt
from siftlane.sources.tables import table
from tests.conftest import SF


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    """The small tables with curbnest's class list in reverse, its cardboard dropped, and without recorded duplicates; one unlabelled image has a size and a proposal."""
    d = tmp_path_factory.mktemp("data")
    for name in os.listdir(SF):
        if name not in ("dropped_dups.parquet", "source_specs.parquet"):
            os.symlink(f"{SF}/{name}", d / name)
    table(spark, SF, "dropped_dups").limit(0).write.parquet(f"{d}/dropped_dups.parquet")
    specs = table(spark, SF, "source_specs")
    changed = F.transform_values("mapping", lambda k, v: F.when((F.col("source") == "curbnest") & (F.lower(k) == "cardboard"), "DROP").otherwise(v))
    specs.withColumn("mapping", changed).write.parquet(f"{d}/source_specs.parquet")
    names = [("curbnest", k, c) for k, c in enumerate(["Organic", "glass", "metal", "cardboard", "paper", "plastic"])]
    spark.createDataFrame(names, "source string, idx int, label string").write.parquet(f"{d}/source_names.parquet")
    cls = specs.where("annotation_type = 'cls'").select("source")
    bare = views.items(spark, SF).join(views.labels(spark, SF).select("ident"), "ident", "left_anti").join(cls, "source", "left_semi").orderBy("key").first()
    spark.createDataFrame([(bare.key, 200, 100)], "image string, width int, height int").write.parquet(f"{d}/image_sizes.parquet")
    spark.createDataFrame([(bare.key, 0, 50.0, 20.0, 150.0, 80.0, 0.8)], "image string, pos bigint, x1 double, y1 double, x2 double, y2 double, confidence double").write.parquet(f"{d}/box_proposals.parquet")
    return str(d), bare.ident


def test_build_does_every_step(spark, data, tmp_path):
    d, bare = data
    with pytest.raises(Halt, match="review"):
        build(spark, d, str(tmp_path), BuildConfig(ack_review=False), say=lambda _: None)
    assert not (tmp_path / "items").exists() and spark.read.parquet(f"{tmp_path}/review_queue").count() > 0
    assert build(spark, d, str(tmp_path), BuildConfig(), say=lambda _: None) == ["items", "quality", "balance", "split"]
    assert build(spark, d, str(tmp_path), BuildConfig(ack_review=False), say=lambda _: None) == []
    items = {r.ident: r for r in spark.read.parquet(f"{tmp_path}/items").collect()}
    before = {r.ident: r.label_text for r in views.labels(spark, SF).where("source = 'curbnest'").collect()}
    seen = 0
    for ident, text in before.items():
        ids = [int(x.split()[0]) for x in text.splitlines() if x.strip()]
        if ids and all(k == 3 for k in ids):
            assert ident not in items
        elif ident in items and ids:
            got = [int(x.split()[0]) for x in items[ident].label_text.splitlines()]
            assert got == [5 - k for k in ids if k != 3]
            seen += 1
    assert seen
    assert [float(x) for x in items[bare].label_text.split()[1:]] == [0.5, 0.5, 0.5, 0.6]
    dups = spark.read.parquet(f"{tmp_path}/dedup")
    gone = {r.key: r.duplicate_of for r in dups.where("NOT kept").collect()}
    assert gone and not set(gone) & {r.key for r in items.values()} and set(gone.values()) <= {r.key for r in items.values()}
    split = {r.key for r in spark.read.parquet(f"{tmp_path}/split").collect()}
    assert split and not split & set(gone)


def test_gate_passes_and_fails(spark, data, tmp_path):
    d, _ = data
    other = tmp_path / "d"
    other.mkdir()
    for name in os.listdir(d):
        os.symlink(f"{d}/{name}", other / name)
    groups = ["plastic", "paper", "cardboard", "metal", "glass", "organic", "wilderness"]
    for k, fail in enumerate((0.3, 0.05)):
        rows = [(g, fail if g == "plastic" else 0.05, 0.1, 0.9) for g in groups]
        spark.createDataFrame(rows, "class_name string, review_fail double, location_fail double, median_iou double").write.mode("overwrite").parquet(f"{other}/review_results.parquet")
        out, config = str(tmp_path / f"o{k}"), BuildConfig(ack_review=False)
        for step in ("remap", "autobox"):
            build(spark, str(other), out, config, only=step, say=lambda _: None)
        if fail > 0.1:
            with pytest.raises(Halt, match="fails"):
                build(spark, str(other), out, config, only="qa", say=lambda _: None)
        else:
            assert build(spark, str(other), out, config, only="qa", say=lambda _: None) == ["qa"]


def test_hashes_given_beside_equal_bytes(spark, data, tmp_path):
    d, _ = data
    other = tmp_path / "d"
    other.mkdir()
    for name in os.listdir(d):
        os.symlink(f"{d}/{name}", other / name)
    keys = [r.key for r in views.items(spark, SF).where("class_name = 'glass' AND source = 'milltray'").orderBy("key").limit(3).collect()]
    spark.createDataFrame([(keys[0], 0), (keys[1], 3), (keys[2], 0xFFFF)], "image string, h bigint").write.parquet(f"{other}/image_hashes.parquet")
    for step in ("remap", "autobox", "qa", "dedup"):
        build(spark, str(other), str(tmp_path / "o"), BuildConfig(), only=step, say=lambda _: None)
    got = {r.key: (r.kept, r.duplicate_of) for r in spark.read.parquet(f"{tmp_path}/o/dedup").collect()}
    assert got[keys[1]] == (False, keys[0]) and got[keys[0]][0] and got[keys[2]][0]
    assert len(got) == spark.read.parquet(f"{tmp_path}/o/remap").where("class_name <> 'wilderness'").count()
