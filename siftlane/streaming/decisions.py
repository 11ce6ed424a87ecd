"""Consensus decisions over a stream of detections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_tallies(stream: DataFrame, tau: float, window: str = "1 day", late: str = "1 hour", time: str = "logged_at") -> DataFrame:
    """``window, object, class_id, q, hi`` from a stream ``object, image_id, severity, class_id, score, <time>``.

    Detections count in the window of their event time; those more than ``late`` behind the latest are dropped, and a window
    is emitted when the watermark has passed it. Times without zone are taken as UTC of the session. Decisions follow with
    `siftlane.operators.consensus.decide`, with the window as the cell.
    """
    timed = stream.withColumn("at", F.col(time).cast("timestamp")).where("at IS NOT NULL AND severity >= 1").withWatermark("at", late)
    tallies = timed.groupBy(F.window("at", window).alias("window"), "object", "class_id").agg(F.count_if(F.col("score") >= tau).alias("q"), F.max("score").alias("hi"))
    return tallies.select(F.col("window.start").alias("cell"), "object", "class_id", "q", "hi")
