"""Label lines, rectangles and their geometry as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def label_lines(text: Column) -> Column:
    """The non-blank lines of a label text, byte order mark and carriage returns gone; an empty array for NULL."""
    plain = F.translate(F.coalesce(text, F.lit("")), "﻿\r", "")
    return F.filter(F.split(plain, "\n"), lambda line: F.trim(line) != "")


def boxes_of(lines: Column) -> Column:
    """``array<struct<class_id, cx, cy, w, h, ok>>``; ``ok`` is false where a line is no box of five numbers within [0, 1]."""

    def one(line: Column) -> Column:
        parts = F.split(F.trim(line), r"\s+")
        class_id = F.get(parts, F.lit(0)).try_cast("int")
        n = [F.get(parts, F.lit(k)).try_cast("double") for k in (1, 2, 3, 4)]
        fine = (F.size(parts) == 5) & class_id.isNotNull() & (class_id >= 0)
        for x in n:
            fine = fine & x.isNotNull() & (x >= 0) & (x <= 1)
        return F.struct(class_id.alias("class_id"), n[0].alias("cx"), n[1].alias("cy"), n[2].alias("w"), n[3].alias("h"), F.coalesce(fine, F.lit(False)).alias("ok"))

    return F.transform(lines, one)


def area(w: Column, h: Column) -> Column:
    return w * h


def aspect(w: Column, h: Column) -> Column:
    """Width by height; NULL for a box without height."""
    return w / F.nullif(h, F.lit(0.0))


def corners(cx: Column, cy: Column, w: Column, h: Column) -> tuple[Column, Column, Column, Column]:
    """Centre form to (left, top, right, bottom)."""
    return cx - w / 2, cy - h / 2, cx + w / 2, cy + h / 2


def edges_touched(cx: Column, cy: Column, w: Column, h: Column, eps: float = 0.005) -> Column:
    """How many of the four borders a box comes within ``eps`` of."""
    left, top, right, bottom = corners(cx, cy, w, h)
    near = [left <= eps, top <= eps, right >= 1 - eps, bottom >= 1 - eps]
    return sum((c.cast("int") for c in near[1:]), near[0].cast("int"))


def overlap(a: tuple[Column, Column, Column, Column], b: tuple[Column, Column, Column, Column]) -> Column:
    """Intersection over union of two corner-form boxes; 0 where they are apart or have no area."""
    wide = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0.0))
    high = F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0.0))
    both = wide * high
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both
    return F.when(union > 0, both / union).otherwise(F.lit(0.0))


def clamp(box: tuple[Column, Column, Column, Column], width: Column, height: Column) -> tuple[Column, Column, Column, Column]:
    """A corner-form pixel box cut to its image."""
    cut = lambda x, most: F.least(F.greatest(x, F.lit(0.0)), most.cast("double"))
    return cut(box[0], width), cut(box[1], height), cut(box[2], width), cut(box[3], height)


def centre_box(margin: float) -> tuple[float, float, float, float]:
    """The box that leaves ``margin`` of the image on each side, in corner form of the unit square."""
    if not 0 <= margin < 0.5:
        raise ValueError("margin must be in [0, 0.5)")
    return margin, margin, 1 - margin, 1 - margin


def label_line(class_id: Column, box: tuple[Column, Column, Column, Column], width: Column, height: Column) -> Column:
    """``class cx cy w h`` with six decimals, from a pixel box in corner form."""
    left, top, right, bottom = box
    return F.format_string("%d %.6f %.6f %.6f %.6f", class_id, (left + right) / 2 / width, (top + bottom) / 2 / height, (right - left) / width, (bottom - top) / height)


def boxes_table(labels: DataFrame) -> DataFrame:
    """``image, pos, class_id, cx, cy, w, h, ok``: one row per label line. labels: ``image, label_text``."""
    exploded = labels.select("image", F.posexplode(boxes_of(label_lines(F.col("label_text")))).alias("pos", "b"))
    return exploded.select("image", "pos", "b.class_id", "b.cx", "b.cy", "b.w", "b.h", "b.ok")
