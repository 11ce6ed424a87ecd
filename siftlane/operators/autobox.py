"""Choosing a box for images that have none: proposals, masks, the centre."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlane.functions.boxes import centre_box

# Share of the image that the largest part of a mask must cover at least and at most, the centre box's margin, and the least value
# of a mask that is foreground.
MASK_LOW, MASK_HIGH, MARGIN, FOREGROUND = 0.05, 0.95, 0.1, 128


def best_proposal(proposals: DataFrame, least: float) -> DataFrame:
    """``image, box, confidence, multibox``: of an image's proposals of at least ``least`` the most confident, the first on ties.

    proposals: ``image, pos, x1, y1, x2, y2, confidence``. ``multibox`` counts all proposals, also the refused.
    """
    fine = F.col("confidence") >= least
    best = F.max_by(F.struct("x1", "y1", "x2", "y2", "confidence"), F.when(fine, F.struct(F.col("confidence"), -F.col("pos"))))
    picked = proposals.groupBy("image").agg(best.alias("b"), F.count("*").alias("n"), F.count_if(fine).alias("good"))
    return picked.where("good > 0").select("image", F.struct("b.x1", "b.y1", "b.x2", "b.y2").alias("box"), F.col("b.confidence").alias("confidence"), (F.col("n") > 1).alias("multibox"))


def mask_box(mask: Column) -> Column:
    """``struct<x1, y1, x2, y2, area>`` of the largest 4-connected part of a mask ``struct<h, w, data: binary>`` (128 and above is foreground).

    Right and bottom are exclusive; of equal parts the one whose first pixel comes first. NULL for no foreground and for masks that don't fit their size.
    """

    @F.pandas_udf("struct<x1: int, y1: int, x2: int, y2: int, area: int>")
    def largest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rows = []
            for h, w, data in zip(frame["h"], frame["w"], frame["data"], strict=True):
                fits = data is not None and not pd.isna(h) and not pd.isna(w) and len(data) == h * w
                rows.append(largest_part(np.frombuffer(data, np.uint8).reshape(int(h), int(w)) >= FOREGROUND) if fits else None)
            empty = (None,) * 5
            yield pd.DataFrame([r or empty for r in rows], columns=["x1", "y1", "x2", "y2", "area"]).astype("Int32")

    return largest(mask)


def largest_part(mask: np.ndarray) -> tuple[int, int, int, int, int] | None:
    """Box and size of the largest 4-connected part; labels are the smallest pixel number reached, spread until nothing changes."""
    if not mask.any():
        return None
    h, w = mask.shape
    big = h * w
    label = np.where(mask, np.arange(big).reshape(h, w), big)
    while True:
        new = label.copy()
        new[1:] = np.minimum(new[1:], label[:-1])
        new[:-1] = np.minimum(new[:-1], label[1:])
        new[:, 1:] = np.minimum(new[:, 1:], label[:, :-1])
        new[:, :-1] = np.minimum(new[:, :-1], label[:, 1:])
        new = np.where(mask, new, big)
        # A label is a pixel of the same part: what that pixel has by now is smaller or equal.
        flat = np.append(new.ravel(), big)
        new = np.where(mask, flat[new], big)
        if np.array_equal(new, label):
            break
        label = new
    ids, sizes = np.unique(label[mask], return_counts=True)
    part = label == ids[int(np.argmax(sizes))]
    ys, xs = np.flatnonzero(part.any(1)), np.flatnonzero(part.any(0))
    return int(xs[0]), int(ys[0]), int(xs[-1]) + 1, int(ys[-1]) + 1, int(sizes.max())


def chain(images: DataFrame, proposals: DataFrame, masks: DataFrame, order: tuple[str, ...] = ("dino", "birefnet")) -> DataFrame:
    """``image, method, box, confidence, flags``: the first step of ``order`` that gives a box, the centre box at last.

    images: ``image, width, height``; proposals: as `best_proposal` gives them; masks: ``image, mask_area, box`` of their largest parts. A mask counts if that part has a
    sensible share of the image's pixels, whatever its box covers. Only ``dino`` has a confidence; only it can be flagged ``multibox``.
    """
    p = proposals.select("image", F.col("box").alias("p_box"), F.col("confidence").alias("p_conf"), "multibox")
    m = masks.select("image", "mask_area", F.col("box").alias("m_box"))
    joined = images.join(p, "image", "left").join(m, "image", "left")
    double = lambda b: F.struct(*[F.col(f"{b}.{k}").cast("double").alias(k) for k in ("x1", "y1", "x2", "y2")])
    share = F.col("mask_area") / (F.col("width").cast("double") * F.col("height"))
    usable = {"dino": F.col("p_box").isNotNull(), "birefnet": F.coalesce(share.between(MASK_LOW, MASK_HIGH), F.lit(False))}
    boxes = {"dino": double("p_box"), "birefnet": double("m_box")}
    left, top, right, bottom = centre_box(MARGIN)
    centre = F.struct((F.col("width") * left).alias("x1"), (F.col("height") * top).alias("y1"), (F.col("width") * right).alias("x2"), (F.col("height") * bottom).alias("y2"))
    method, box = F.lit("centerbox"), centre
    for step in reversed(order):
        method, box = F.when(usable[step], F.lit(step)).otherwise(method), F.when(usable[step], boxes[step]).otherwise(box)
    out = joined.select("image", method.alias("method"), box.alias("box"), "p_conf", "multibox")
    flags = F.array_compact(F.array(F.when((F.col("method") == "dino") & F.col("multibox"), "multibox"), F.when(F.col("method") == "centerbox", "centerbox")))
    return out.select("image", "method", "box", F.when(F.col("method") == "dino", F.col("p_conf")).alias("confidence"), flags.alias("flags"))
