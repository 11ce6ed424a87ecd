"""The label-quality filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftlane.functions.boxes import boxes_of, label_lines

# What the filter refuses.
METHODS, CONFIDENCE, LARGEST, SMALLEST = ("centerbox",), 0.30, 0.92, 0.005


def largest_box(label_text: Column) -> Column:
    """Area of the largest box of a label text; NULL for no box or any line that is none."""
    boxes = boxes_of(label_lines(label_text))
    fine = (F.size(boxes) > 0) & F.forall(boxes, lambda b: b["ok"])
    return F.when(fine, F.array_max(F.transform(boxes, lambda b: b["w"] * b["h"])))


def latest_record(records: DataFrame, group: str = "ident") -> DataFrame:
    """The record that holds for each item: the latest, then the larger confidence, then the smaller record_id."""
    order = [F.col("boxed_at").desc_nulls_last(), F.col("confidence").desc_nulls_last(), F.col("record_id")]
    once = records.dropDuplicates([group, "record_id"])
    return once.withColumn("rn", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where("rn = 1").drop("rn")


def refusal(method: Column, confidence: Column, largest: Column, known: Column, methods: Sequence[str] = METHODS, null_confidence_as: float | None = 0.0) -> Column:
    """The first reason to refuse an item, NULL to keep it.

    Without provenance (``known`` false) only geometry counts; an unreadable label has none. Values at a
    threshold are kept. ``null_confidence_as`` stands in for a missing confidence; None keeps such items.
    """
    filled = confidence if null_confidence_as is None else F.coalesce(confidence, F.lit(null_confidence_as))
    return (
        F.when(known & method.isin(*methods), "method")
        .when(known & (filled < CONFIDENCE), "low_confidence")
        .when(largest > LARGEST, "box_too_large")
        .when(largest < SMALLEST, "box_too_small")
    )


def quality_filter(items: DataFrame, provenance: DataFrame, null_confidence_as: float | None = 0.0) -> DataFrame:
    """items (``ident, key, label_text``) with ``reason``; provenance: ``ident, method, confidence``, one row per ident."""
    slim = provenance.select("ident", "method", "confidence", F.lit(True).alias("known"))
    joined = items.join(slim, "ident", "left")
    reason = refusal(F.col("method"), F.col("confidence"), largest_box(F.col("label_text")), F.coalesce("known", F.lit(False)), null_confidence_as=null_confidence_as)
    return joined.select("key", reason.alias("reason"))


def reasons(filtered: DataFrame) -> DataFrame:
    return filtered.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("items"))
