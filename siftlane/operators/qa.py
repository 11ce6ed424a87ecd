"""Statistical checks of box labels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftlane.functions.boxes import area, aspect, corners, edges_touched, overlap

# Flags in their order, and the thresholds they use.
FLAGS = ("box_count", "area_extreme", "area_zscore", "aspect_zscore", "edge_contact", "low_confidence", "centerbox")
AREA_LOW, AREA_HIGH, Z_MOST, EDGES, CONFIDENCE = 0.05, 0.95, 3.0, 3, 0.30
REVIEW_MOST, LOCATION_MOST, IOU_LEAST = 0.10, 0.20, 0.80


def zscores(boxes: DataFrame) -> DataFrame:
    """Single-box images with the z-scores of area and aspect within their class.

    boxes: ``image, class_id, cx, cy, w, h``. Population deviation over the single-box images of a class; NULL where a class has fewer than
    two such images; a deviation of 0 gives NULL, never an outlier.
    """
    single = boxes.withColumn("n", F.count("*").over(Window.partitionBy("image"))).where("n = 1").drop("n")
    shaped = single.withColumn("area", area(F.col("w"), F.col("h"))).withColumn("aspect", aspect(F.col("w"), F.col("h")))
    # Moments by class first: a class is a hot key, its few numbers are not.
    stats = shaped.groupBy("class_id").agg(
        F.count("*").alias("n"), F.avg("area").alias("ma"), F.stddev_pop("area").alias("sa"), F.count("aspect").alias("np"), F.avg("aspect").alias("mp"), F.stddev_pop("aspect").alias("sp")
    )
    z = lambda x, m, s, n: F.when(F.col(n) >= 2, (F.col(x) - F.col(m)) / F.nullif(F.round(s, 12), F.lit(0.0)))
    return shaped.join(stats, "class_id").select(
        "image", "class_id", "cx", "cy", "w", "h", "area", "aspect", z("area", "ma", "sa", "n").alias("area_z"), z("aspect", "mp", "sp", "np").alias("aspect_z")
    )


def qa_flags(images: DataFrame, boxes: DataFrame) -> DataFrame:
    """``image, n_boxes, class_id, flags``: the flags of every image that has provenance, in the fixed order.

    images: ``image, method, confidence``. An image whose number of boxes isn't one gets ``box_count`` and no flag of geometry.
    """
    counts = boxes.groupBy("image").agg(F.count("*").alias("n_boxes"))
    shapes = zscores(boxes)
    joined = images.join(counts, "image", "left").join(shapes, "image", "left").withColumn("n_boxes", F.coalesce("n_boxes", F.lit(0)).cast("bigint"))
    one = F.col("n_boxes") == 1
    tests: Mapping[str, Column] = {
        "box_count": ~one,
        "area_extreme": one & ((F.col("area") < AREA_LOW) | (F.col("area") > AREA_HIGH)),
        "area_zscore": one & (F.abs("area_z") > Z_MOST),
        "aspect_zscore": one & (F.abs("aspect_z") > Z_MOST),
        "edge_contact": one & (edges_touched(F.col("cx"), F.col("cy"), F.col("w"), F.col("h")) >= EDGES),
        "low_confidence": F.col("confidence") < CONFIDENCE,
        "centerbox": F.col("method") == "centerbox",
    }
    return joined.select("image", "n_boxes", "class_id", F.array_compact(F.array(*[F.when(tests[f], F.lit(f)) for f in FLAGS])).alias("flags"))


def flag_counts(flagged: DataFrame) -> DataFrame:
    """How many images have each flag; flags nobody has have no row."""
    return flagged.select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count("*").alias("images"))


def gate(review_fail: Column, location_fail: Column, median_iou: Column) -> Column:
    """``pass`` or ``fail`` of the acceptance gate; ``pending`` while a figure is NULL."""
    fine = (review_fail <= REVIEW_MOST) & (location_fail <= LOCATION_MOST) & (median_iou >= IOU_LEAST)
    return F.when(review_fail.isNull() | location_fail.isNull() | median_iou.isNull(), "pending").when(fine, "pass").otherwise("fail")


def best_overlaps(ours: DataFrame, reference: DataFrame) -> DataFrame:
    """``image, iou``: the best overlap of any two boxes of an image both sides know; 0 where a side has no usable box."""
    cols = ["cx", "cy", "w", "h"]
    a = ours.select("image", *[F.col(c).alias(f"a_{c}") for c in cols])
    b = reference.select("image", *[F.col(c).alias(f"b_{c}") for c in cols])
    iou = overlap(corners(*[F.col(f"a_{c}") for c in cols]), corners(*[F.col(f"b_{c}") for c in cols]))
    return a.join(b, "image").groupBy("image").agg(F.coalesce(F.max(iou), F.lit(0.0)).alias("iou"))


def overlap_stats(per_image: DataFrame) -> DataFrame:
    """Mean, inclusive quartiles, extremes and the share of at least ``IOU_LEAST`` of ``iou``: one row, NULLs when empty."""
    quartile = lambda q: F.expr(f"percentile(iou, CAST({q} AS DOUBLE))")
    return per_image.agg(
        F.count("*").alias("images"), F.avg("iou").alias("mean"), quartile(0.25).alias("q1"), quartile(0.5).alias("median"), quartile(0.75).alias("q3"),
        F.min("iou").alias("low"), F.max("iou").alias("high"), F.avg((F.col("iou") >= IOU_LEAST).cast("double")).alias("frac_good"),
    )


def stray_labels(labels: DataFrame, images: DataFrame) -> DataFrame:
    """Labels of images without provenance."""
    return labels.join(images, "image", "left_anti")


def review_queue(flagged: DataFrame) -> DataFrame:
    """One row per image and flag, in the order in which reviewers see them when sorted by (confidence, image)."""
    return flagged.withColumn("flag", F.explode("flags")).withColumn("all_flags", F.array_join("flags", "|")).drop("flags")
