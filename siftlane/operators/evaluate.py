"""Reading evaluation results: curves, tiers, verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The precision to hold, and what a model must reach overall and in each class.
PRECISION, OVERALL, CLASS_MAP, CLASS_RECALL = 0.95, 0.80, 0.75, 0.70
BINS = 40


def precision_curve(scored: DataFrame, points: int = 101) -> DataFrame:
    """``class_id, idx, confidence, precision, recall``: on a grid of confidences, from ``class_id, score, correct``.

    Counts per class and grid cell first, then running sums from the top over these few cells: rows are read once and sorted never. Precision
    is 1 where nothing is left above the confidence.
    """
    cell = F.least(F.floor(F.col("score") * (points - 1) + 1e-9), F.lit(points - 1)).cast("int")
    cells = scored.groupBy("class_id", cell.alias("idx")).agg(F.count("*").alias("n"), F.count_if("correct").alias("good"))
    axis = scored.select("class_id").distinct().withColumn("idx", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    above = Window.partitionBy("class_id").orderBy("idx").rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy("class_id")
    dense = axis.join(cells, ["class_id", "idx"], "left").fillna(0, ["n", "good"])
    sums = dense.select("class_id", "idx", F.sum("n").over(above).alias("n"), F.sum("good").over(above).alias("good"), F.sum("good").over(whole).alias("all_good"))
    return sums.select(
        "class_id", "idx", (F.col("idx") / (points - 1)).alias("confidence"), F.when(F.col("n") > 0, F.col("good") / F.col("n")).otherwise(1.0).alias("precision"),
        F.when(F.col("all_good") > 0, F.col("good") / F.col("all_good")).otherwise(0.0).alias("recall"),
    )


def sustained_confidence(curve: DataFrame, floor: float = PRECISION) -> DataFrame:
    """``class_id, conf``: the least confidence from which precision stays at ``floor``; NULL where the last point is below it."""
    marks = curve.groupBy("class_id").agg(F.max(F.when(F.col("precision") < floor, F.col("idx"))).alias("last"), F.min("idx").alias("first"))
    want = marks.select("class_id", F.coalesce(F.col("last") + 1, F.col("first")).alias("idx"))
    return want.join(curve.select("class_id", "idx", F.col("confidence").alias("conf")), ["class_id", "idx"], "left").select("class_id", "conf")


def interpolate(curve: DataFrame, at: DataFrame) -> DataFrame:
    """``class_id, conf, precision``: the curve's precision at a confidence, linear between points. at: ``class_id, conf``."""
    pairs = curve.select("class_id", F.col("confidence").alias("c0"), F.col("precision").alias("p0")).withColumn("c1", F.lead("c0").over(Window.partitionBy("class_id").orderBy("c0"))).withColumn(
        "p1", F.lead("p0").over(Window.partitionBy("class_id").orderBy("c0"))
    )
    inside = (F.col("conf") >= F.col("c0")) & ((F.col("conf") < F.col("c1")) | F.col("c1").isNull())
    found = at.join(pairs, "class_id").where(inside)
    share = (F.col("conf") - F.col("c0")) / (F.col("c1") - F.col("c0"))
    return found.select("class_id", "conf", F.coalesce(F.col("p0") + share * (F.col("p1") - F.col("p0")), F.col("p0")).alias("precision"))


def escalation(metrics: DataFrame, classes: DataFrame, overall: float) -> DataFrame:
    """``class_name, map50, recall, passed, all_passed``: every class against its floors; a class without metrics fails with NULLs."""
    fine = (F.col("map50") >= CLASS_MAP) & (F.col("recall") >= CLASS_RECALL)
    joined = classes.join(metrics, "class_name", "left").select("class_name", "map50", "recall", F.coalesce(fine, F.lit(False)).alias("passed"))
    return joined.withColumn("all_passed", F.min(F.col("passed")).over(Window.partitionBy()) & F.lit(overall >= OVERALL))


def headline(tiers: DataFrame) -> DataFrame:
    """The rows of the clean tier, or of val where there is no clean one. tiers: ``tier, ...``."""
    rank = F.when(F.col("tier") == "clean_test", 0).when(F.col("tier") == "val", 1)
    return tiers.withColumn("rank", rank).where("rank IS NOT NULL").withColumn("best", F.min("rank").over(Window.partitionBy())).where("rank = best").drop("rank", "best")


def severity_curve(points: DataFrame, clean: DataFrame) -> DataFrame:
    """Points by severity with the clean one as severity 0; of two points of a severity the later (``points``) holds. ``severity, value``."""
    both = clean.withColumn("late", F.lit(0)).unionByName(points.withColumn("late", F.lit(1)))
    return both.groupBy("severity").agg(F.max_by("value", "late").alias("value"))


def worst_tier(points: DataFrame) -> DataFrame:
    """The rows of the highest severity."""
    return points.withColumn("most", F.max("severity").over(Window.partitionBy())).where("severity = most").drop("most")


def best_epoch(epochs: DataFrame, metric: str) -> DataFrame:
    """The epoch with the highest metric, the first on ties."""
    return epochs.orderBy(F.col(metric).desc_nulls_last(), "epoch").limit(1)


def resumable_run(runs: DataFrame) -> DataFrame:
    """The newest run that has finished an epoch. runs: ``run_id, mtime, epoch``."""
    return runs.where("epoch >= 0").orderBy(F.col("mtime").desc(), "run_id").limit(1)


def density(scores: DataFrame, bins: int = BINS) -> DataFrame:
    """``bin, n, density`` of ``score`` over equal bins of [0, 1], the last closed on the right; empty bins have 0."""
    cell = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).cast("int")
    counts = scores.groupBy(cell.alias("bin")).agg(F.count("*").alias("n"))
    axis = scores.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    total = F.sum("n").over(Window.partitionBy())
    dense = axis.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))
    return dense.select("bin", "n", F.when(total > 0, F.col("n") * bins / total).otherwise(0.0).alias("density"))


def tidy_metrics(wide: DataFrame, key: str) -> DataFrame:
    """``key, metric, value`` of a table with one column per metric."""
    names = [c for c in wide.columns if c != key]
    return wide.unpivot([key], names, "metric", "value")


def uneven_curves(curves: DataFrame) -> DataFrame:
    """Tiers and classes whose curve has another number of points than most of its tier. curves: ``tier, class_name, idx``."""
    points = curves.groupBy("tier", "class_name").agg(F.count("*").alias("points"))
    usual = points.groupBy("tier").agg(F.mode("points", True).alias("usual"))
    return points.join(usual, "tier").where("points <> usual").select("tier", "class_name", "points")


def tier_curves(tiers: DataFrame, curves: DataFrame, fallback: str = "val") -> DataFrame:
    """``tier, curve``: the curve file named like the tier, else that of ``fallback``. tiers: ``tier``; curves: ``curve``."""
    named = curves.select(F.col("curve").alias("tier"), "curve")
    return tiers.join(named, "tier", "left").select("tier", F.coalesce("curve", F.lit(fallback)).alias("curve"))


def tier_comparison(tiers: DataFrame, classes: DataFrame) -> DataFrame:
    """``tier, class_name, map50``: val, test1 and the worst degraded tier side by side; a class that a tier lacks has 0.

    tiers: ``tier, severity, class_name, map50``, degraded tiers named ``test2...``.
    """
    late = F.startswith("tier", F.lit("test2"))
    worst = F.max(F.when(late, F.col("severity"))).over(Window.partitionBy())
    kept = tiers.withColumn("worst", worst).where(F.col("tier").isin("val", "test1") | (late & (F.col("severity") == F.col("worst")))).drop("worst")
    cells = kept.select("tier").distinct().crossJoin(F.broadcast(classes.select("class_name")))
    return cells.join(kept.select("tier", "class_name", "map50"), ["tier", "class_name"], "left").select("tier", "class_name", F.coalesce("map50", F.lit(0.0)).alias("map50"))
