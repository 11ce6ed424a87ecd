"""From detections to one decision per object: a class, or NULL for the rest bin."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_frames(detections: DataFrame) -> DataFrame:
    """The best detection of each (object, image, severity): highest score, then lowest class."""
    best = F.max_by(F.struct("class_id", "score"), F.struct(F.col("score"), -F.col("class_id")))
    return detections.groupBy("object", "image_id", "severity").agg(best.alias("b")).select("object", "image_id", "severity", "b.class_id", "b.score")


def top_scores(detections: DataFrame) -> DataFrame:
    """The highest score of each (image, severity)."""
    return detections.groupBy("image_id", "severity").agg(F.max("score").alias("score"))


def tally(votes: DataFrame, tau: DataFrame) -> DataFrame:
    """``cell, object, class_id, q, hi``: qualified votes and the highest score per class; ``tau``: ``cell, class_id, tau``.

    A vote for a class that has no threshold is an error. The number of rows is set by objects, classes and distinct thresholds, not by frames.
    """
    joined = votes.join(tau, "class_id", "left")
    known = F.coalesce(F.col("tau"), F.raise_error(F.concat(F.lit("no threshold for class "), F.coalesce(F.col("class_id").cast("string"), F.lit("NULL")))).cast("double"))
    return joined.groupBy("cell", "object", "class_id").agg(F.count_if(F.col("score") >= known).alias("q"), F.max("score").alias("hi"))


def decide(tallies: DataFrame, min_votes: int | None = None, high_water: float | None = None) -> DataFrame:
    """``cell, object, decision``. The class with most qualified votes (the lowest on ties) if it has at least ``min_votes``, more than
    half of all qualified votes, and a score of at least ``high_water``; else NULL. Without arguments both are columns."""
    least = F.col("min_votes") if min_votes is None else F.lit(min_votes)
    water = F.col("high_water") if high_water is None else F.lit(high_water)
    keep = [c for c in ("min_votes", "high_water") if c in tallies.columns]
    top = F.max_by(F.struct("class_id", "q", "hi"), F.struct(F.col("q"), -F.col("class_id")))
    one = tallies.groupBy("cell", "object", *keep).agg(top.alias("t"), F.sum("q").alias("all_q"))
    return one.select("cell", "object", F.when((F.col("t.q") >= least) & (2 * F.col("t.q") > F.col("all_q")) & (F.col("t.hi") >= water), F.col("t.class_id")).alias("decision"))


def with_silent(truth: DataFrame, decisions: DataFrame) -> DataFrame:
    """Every object of ``truth``; one without votes is decided as rest."""
    return truth.join(decisions, "object", "left")


def group_truth(assignments: DataFrame) -> DataFrame:
    """``object, class_id, mixed``: the class of every group of val items; ``mixed`` marks groups of several classes, which are errors."""
    per = assignments.groupBy("object").agg(F.min("class_id").alias("class_id"), F.max("class_id").alias("high"))
    return per.select("object", "class_id", (F.col("class_id") != F.col("high")).alias("mixed"))


def sightings(votes: DataFrame, low: int = 5, high: int = 15, seed: int = 42) -> DataFrame:
    """``object, draw, class_id, score``: for each object between ``low`` and ``high`` draws with replacement of its votes.

    Degraded frames (severity 1 and up) if it has any, else clean ones. Number and picks come from md5 of seed, object and draw, so they are the
    same on every engine and in every partitioning.
    """
    pool = votes.withColumn("degraded", (F.col("severity") >= 1).cast("int"))
    best = pool.groupBy("object").agg(F.max("degraded").alias("degraded"))
    pool = pool.join(best, ["object", "degraded"])
    place = Window.partitionBy("object").orderBy("image_id", "severity")
    pool = pool.withColumn("k", F.row_number().over(place) - 1)
    number = lambda *parts: F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("bigint")
    sizes = pool.groupBy("object").agg(F.count("*").alias("size"))
    m = (number(F.lit(str(seed)), F.lit("draws"), F.col("object")) % (high - low + 1)) + low
    draws = sizes.withColumn("draw", F.explode(F.sequence(F.lit(1), m.cast("int"))))
    draws = draws.withColumn("k", (number(F.lit(str(seed)), F.col("draw").cast("string"), F.col("object")) % F.col("size")).cast("int"))
    return draws.join(pool.select("object", "k", "class_id", "score"), ["object", "k"]).select("object", "draw", "class_id", "score")
