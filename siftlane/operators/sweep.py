"""The threshold grid: sweep, front, choice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftlane.operators.consensus import tally

# Bounds of a per-class threshold, the span from which it pays, and the share of wrong bins that is allowed.
TAU_LOW, TAU_HIGH, SPAN, WRONG_MOST = 0.30, 0.60, 0.10, 0.02


def grid(spark: SparkSession, taus: Sequence[float], votes: Sequence[int], waters: Sequence[float]) -> DataFrame:
    """``cell_idx, tau_frame, min_votes, high_water`` in grid order (the order breaks ties)."""
    rows = [(float(t), int(v), float(w)) for t in taus for v in votes for w in waters]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "cell_idx int, tau_frame double, min_votes int, high_water double")


def per_class_anchors(points: DataFrame, low: float = TAU_LOW, high: float = TAU_HIGH) -> DataFrame:
    """``class_id, anchor, per_class``: the clamped confidence at the wanted precision, ``high`` where there is none.

    points: ``class_id, conf``. ``per_class`` tells whether the anchors lie more than ``SPAN`` apart.
    """
    anchor = F.least(F.greatest(F.coalesce("conf", F.lit(high)), F.lit(low)), F.lit(high))
    w = Window.partitionBy()
    anchors = points.select("class_id", anchor.alias("anchor"))
    return anchors.withColumn("per_class", (F.max("anchor").over(w) - F.min("anchor").over(w)) > SPAN)


def cell_taus(cells: DataFrame, anchors: DataFrame, low: float = TAU_LOW, high: float = TAU_HIGH) -> DataFrame:
    """``tau_frame, class_id, tau``: the anchors moved so that their mean is the grid's value, clamped; the grid's value itself in global mode."""
    mean = anchors.select("*", F.avg("anchor").over(Window.partitionBy()).alias("mean"))
    moved = F.least(F.greatest(F.col("anchor") + F.col("tau_frame") - F.col("mean"), F.lit(low)), F.lit(high))
    return cells.select("tau_frame").distinct().crossJoin(F.broadcast(mean)).select("tau_frame", "class_id", F.when(F.col("per_class"), moved).otherwise(F.col("tau_frame")).alias("tau"))


def sweep(votes: DataFrame, truth: DataFrame, cells: DataFrame, taus: DataFrame) -> DataFrame:
    """``cell_idx, tau_frame, tau_mean, min_votes, high_water, wrong_bin_rate, rest_rate`` for every cell.

    truth: ``object, class_id`` with NULL for objects of no class. Wrong: a known object in another class's bin or an unknown one in any bin, of all
    objects; rest: known objects without a decision, of the known ones. Votes are counted once per threshold; votes and
    water only filter that small table.
    """
    tallies = tally(votes, taus.withColumnRenamed("tau_frame", "cell"))
    top = F.max_by(F.struct("class_id", "q", "hi"), F.struct(F.col("q"), -F.col("class_id")))
    one = tallies.groupBy("cell", "object").agg(top.alias("t"), F.sum("q").alias("all_q"))
    # What decides about an object in every cell of a threshold.
    facts = truth.withColumnRenamed("class_id", "truth").join(one, "object", "left")
    sides = F.when(F.col("truth").isNull(), "wild").when(F.col("t.class_id") == F.col("truth"), "right").otherwise("wrong")
    lead = F.coalesce(2 * F.col("t.q") > F.col("all_q"), F.lit(False))
    slim = facts.select("cell", sides.alias("side"), F.when(lead, F.col("t.q")).otherwise(F.lit(-1)).alias("q"), F.coalesce("t.hi", F.lit(-1.0)).alias("hi"))
    # The objects come down to counts: votes beyond the largest minimum are alike, and so are scores between two waters.
    axes = cells.agg(F.max("min_votes").alias("most"), F.array_sort(F.collect_set("high_water")).alias("waters"))
    level = lambda score: F.size(F.filter("waters", lambda w: w <= score))
    counts = slim.crossJoin(axes).groupBy("cell", "side", F.least("q", "most").alias("q"), level(F.col("hi")).alias("level")).agg(F.count("*").alias("objects"))
    flat = cells.crossJoin(axes).withColumn("need", level(F.col("high_water"))).join(counts, F.col("tau_frame") == F.col("cell"))
    decided = (F.col("q") >= F.col("min_votes")) & (F.col("level") >= F.col("need"))
    part = lambda side: F.sum(F.when(F.col("side") != side, F.col("objects")).otherwise(0))
    hits = flat.where(decided).groupBy("cell_idx").agg(part("right").alias("bad"), part("wild").alias("binned"))
    totals = truth.agg(F.count("*").alias("n"), F.count("class_id").alias("known"))
    means = taus.groupBy("tau_frame").agg(F.avg("tau").alias("tau_mean"))
    return (
        cells.join(hits, "cell_idx", "left").crossJoin(F.broadcast(totals)).join(means, "tau_frame")
        .select(
            "cell_idx", "tau_frame", F.round("tau_mean", 9).alias("tau_mean"), "min_votes", "high_water",
            F.round(F.coalesce("bad", F.lit(0)) / F.col("n"), 9).alias("wrong_bin_rate"),
            F.round((F.col("known") - F.coalesce("binned", F.lit(0))) / F.col("known"), 9).alias("rest_rate"),
        )
    )


def front(cells: DataFrame) -> DataFrame:
    """Cells that no other beats: not worse in both rates and better in one. Equal cells all stay."""
    other = cells.select(F.col("wrong_bin_rate").alias("w2"), F.col("rest_rate").alias("r2")).distinct()
    beaten = (F.col("w2") <= F.col("wrong_bin_rate")) & (F.col("r2") <= F.col("rest_rate")) & ((F.col("w2") < F.col("wrong_bin_rate")) | (F.col("r2") < F.col("rest_rate")))
    return cells.join(other, beaten, "left_anti")


def choose(cells: DataFrame, most: float = WRONG_MOST) -> DataFrame:
    """The chosen cell with ``feasible``: of the front within ``most`` wrong the one with least rest; else the least wrong of all."""
    marked = front(cells).where(F.col("wrong_bin_rate") <= most).withColumn("feasible", F.lit(True)).withColumn("a", F.col("rest_rate")).withColumn("b", F.col("wrong_bin_rate"))
    fallback = cells.withColumn("feasible", F.lit(False)).withColumn("a", F.col("wrong_bin_rate")).withColumn("b", F.col("rest_rate"))
    both = marked.unionByName(fallback)
    return both.orderBy(F.col("feasible").desc(), "a", "b", "cell_idx").limit(1).drop("a", "b")


def skyline(cells: DataFrame) -> DataFrame:
    """Cells in order of wrong rate whose rest rate is below that of all before; of equal cells the first stays."""
    before = Window.orderBy("wrong_bin_rate", "rest_rate", "cell_idx").rowsBetween(Window.unboundedPreceding, -1)
    return cells.withColumn("least", F.min("rest_rate").over(before)).where("least IS NULL OR rest_rate < least").drop("least")
