"""Group-aware splits: leave-one-source-out, wild sources, a clean holdout, stratified train and val."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftlane.functions.hashing import rank_hash
from siftlane.functions.ranking import place, running_sum, twister_place
from siftlane.operators.checks import DataError
from siftlane.operators.graph import group_ids, primary_stratum
from siftlane.session import Scratch


def route_sources(items: DataFrame, leave_out: str | None, wild: list[str] | None = None) -> DataFrame:
    """items with ``split``: ``test`` for the left-out source, ``wild_test`` for the sources that are for tests only, NULL for the pool."""
    route = F.when(F.col("source") == leave_out, "test") if leave_out else F.when(F.lit(False), "test")
    return items.withColumn("split", route.when(F.col("source").isin(wild or []), "wild_test"))


def _places(groups: DataFrame, purpose: str, seed: int, generator: str = "hash") -> DataFrame:
    """Groups (``group_id, source, class_name``) with their ``place`` in the seeded order of their stratum."""
    if generator == "twister":
        return twister_place(groups.select("group_id", "source", "class_name"), ["source", "class_name"], purpose, "group_id", seed)
    label = F.concat_ws(":", F.lit(purpose), "source", "class_name")
    return place(groups, ["source", "class_name"], rank_hash(seed, label, F.col("group_id")), "group_id")


def clean_holdout(groups: DataFrame, sources: list[str], fraction: float, seed: int = 42, generator: str = "hash") -> DataFrame:
    """``group_id`` of the first ``round(n * fraction)`` groups of each stratum of the clean sources."""
    eligible = _places(groups.where(F.col("source").isin(sources)), "clean_holdout", seed, generator)
    counts = eligible.groupBy("source", "class_name").agg(F.floor(F.count("*") * F.lit(float(fraction)) + 0.5).alias("take"))
    return eligible.join(counts, ["source", "class_name"]).where("place <= take").select("group_id")


def train_val(spark: SparkSession, members: DataFrame, groups: DataFrame, fraction: float = 0.15, seed: int = 42, generator: str = "hash") -> DataFrame:
    """``group_id, split`` with about ``fraction`` of each stratum's items in val.

    members: ``group_id, source, class_name`` per item; groups: the primary stratum of each group. In the seeded order of a stratum groups are
    taken for val while the stratum's count is below its target. A group that also has members of other strata adds these to
    *their* counts, and strata go in sorted order, so a later stratum starts with what earlier ones have given it. Per
    stratum that is a running sum over its groups, shifted by this start: one pass for all strata, then one small sum per stratum
    that gives anything away.
    """
    scratch = Scratch(spark, "trainval")
    parts = members.groupBy("group_id", "source", "class_name").agg(F.count("*").alias("n"))
    parts = scratch.keep(parts.join(groups.select("group_id", F.col("source").alias("ps"), F.col("class_name").alias("pc")), "group_id"), "parts")
    own = parts.where("source = ps AND class_name = pc").select("group_id", "source", "class_name", F.col("n").alias("own"))
    label = F.concat_ws(":", F.lit("split"), "source", "class_name")
    if generator == "twister":
        shuffled = own.join(_places(own, "split", seed, generator).select("group_id", "place"), "group_id")
        w = Window.partitionBy("source", "class_name").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
        placed = shuffled.withColumn("before", F.coalesce(F.sum("own").over(w), F.lit(0))).drop("place")
    else:
        placed = running_sum(own, ["source", "class_name"], rank_hash(seed, label, F.col("group_id")), "group_id", F.col("own"), "before")
    placed = scratch.keep(placed, "placed")
    sizes = {(r["source"], r["class_name"]): r["n"] for r in members.groupBy("source", "class_name").agg(F.count("*").alias("n")).collect()}
    targets = {s: math.floor(n * fraction + 0.5) for s, n in sizes.items()}
    # Only groups of several strata couple strata.
    foreign = parts.where("NOT (source = ps AND class_name = pc)").select("group_id", "ps", "pc", F.col("source").alias("ts"), F.col("class_name").alias("tc"), "n")
    gifts = placed.select("group_id", F.col("before")).join(foreign, "group_id").groupBy("ps", "pc", "ts", "tc", "before").agg(F.sum("n").alias("n"))
    gifts = scratch.keep(gifts, "gifts")
    givers = {(r["ps"], r["pc"]) for r in gifts.select("ps", "pc").distinct().collect()}
    start, room = dict.fromkeys(sizes, 0), {}
    for s in sorted(sizes):
        room[s] = targets[s] - start[s]  # what later strata give comes too late
        if s not in givers or room[s] <= 0:
            continue
        taken = gifts.where((F.col("ps") == s[0]) & (F.col("pc") == s[1]) & (F.col("before") < room[s]))
        for r in taken.groupBy("ts", "tc").agg(F.sum("n").alias("n")).collect():
            start[r["ts"], r["tc"]] += r["n"]
    limits = spark.createDataFrame([(a, b, room[a, b]) for a, b in sizes], "source string, class_name string, room bigint")
    return placed.join(limits, ["source", "class_name"]).select("group_id", F.when(F.col("before") < F.col("room"), "val").otherwise("train").alias("split"))


def split_items(
    spark: SparkSession,
    items: DataFrame,
    edges: DataFrame,
    leave_out: str | None,
    wild: list[str] | None = None,
    clean_sources: list[str] | None = None,
    clean_fraction: float = 0.0,
    fraction: float = 0.15,
    seed: int = 42,
    generator: str = "hash",
) -> DataFrame:
    """``key, class_name, source, split, group_id`` for all items; groups exist only in the pool of train, val and clean_test.

    ``generator``: ``hash``, or ``twister`` for the orders of Python's generator (see `twister_place`).
    """
    if not 0 < fraction < 1:
        raise DataError(f"the val fraction must lie between 0 and 1, not {fraction}")
    if leave_out is not None and not items.where(F.col("source") == leave_out).take(1):
        raise DataError(f"no item comes from the left-out source {leave_out}")
    scratch = Scratch(spark, "split")
    routed = scratch.keep(route_sources(items, leave_out, wild), "routed")
    pool = routed.where("split IS NULL").drop("split")
    grouped = scratch.keep(group_ids(spark, pool, edges), "grouped")
    strata = scratch.keep(primary_stratum(grouped), "strata")
    clean = scratch.keep(clean_holdout(strata, clean_sources or [], clean_fraction, seed, generator), "clean")
    rest = grouped.join(clean, "group_id", "left_anti")
    two = train_val(spark, rest, strata.join(clean, "group_id", "left_anti"), fraction, seed, generator)
    by_group = two.unionByName(clean.withColumn("split", F.lit("clean_test")))
    cols = ["key", "class_name", "source", "split", "group_id"]
    inside = grouped.join(by_group, "group_id").select(*cols)
    outside = routed.where("split IS NOT NULL").withColumn("group_id", F.lit(None).cast("string")).select(*cols)
    return inside.unionByName(outside)


def split_counts(split: DataFrame) -> DataFrame:
    return split.groupBy("split", "class_name").agg(F.count("*").alias("items"))


def composition(split: DataFrame) -> DataFrame:
    """Items per split, class and source."""
    return split.groupBy("split", "class_name", "source").agg(F.count("*").alias("items"))


def dense_composition(split: DataFrame) -> DataFrame:
    """The composition with a 0 in every cell of the splits, classes and sources that occur."""
    counts = composition(split)
    axes = [counts.select(c).distinct() for c in ("split", "class_name", "source")]
    cells = axes[0].crossJoin(axes[1]).crossJoin(axes[2])
    return cells.join(counts, ["split", "class_name", "source"], "left").withColumn("items", F.coalesce("items", F.lit(0)))
