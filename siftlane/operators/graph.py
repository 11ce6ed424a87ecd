"""Connected components of edge tables, and strata of groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftlane.session import Scratch

MAX_ROUNDS = 100


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``key, group_id``: every end of an edge ``key_a, key_b`` with the smallest key it is linked to.

    Each round a vertex points to its smallest neighbour, or to itself if that is larger; following the pointers twice as far each time leads
    every vertex to a local minimum, and edges are redrawn between the minima. At most half of the vertices are minima, so the graph shrinks
    geometrically. NULL ends and loops don't count.
    """
    scratch = Scratch(spark, "components")
    ends = edges.select(F.col("key_a").alias("a"), F.col("key_b").alias("b")).where("a <> b")
    current = scratch.keep(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges0")
    rounds: list[DataFrame] = []
    depths: list[int] = []
    while current.take(1):
        step = len(rounds)
        if step >= MAX_ROUNDS:
            raise RuntimeError("components don't settle")
        low = current.select(F.col("b").alias("v"), F.col("a").alias("p")).unionByName(current.select(F.col("a").alias("v"), F.col("a").alias("p")))
        minimum = scratch.keep(low.groupBy("v").agg(F.min("p").alias("p")), f"low{step}_0")
        for jump in range(1, MAX_ROUNDS):
            further = minimum.join(minimum.select(F.col("v").alias("p"), F.col("p").alias("pp")), "p").select("v", F.col("pp").alias("p"), (F.col("p") != F.col("pp")).alias("moved"))
            further = scratch.keep(further, f"low{step}_{jump}")
            minimum = further.select("v", "p")
            scratch.drop(f"low{step}_{jump - 1}")
            if not further.where("moved").take(1):
                break
        a, b = minimum.select(F.col("v").alias("a"), F.col("p").alias("x")), minimum.select(F.col("v").alias("b"), F.col("p").alias("y"))
        new = current.join(a, "a").join(b, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        current = scratch.keep(new, f"edges{step + 1}")
        scratch.drop(f"edges{step}")
        rounds.append(minimum)
        depths.append(jump)
    if not rounds:
        return spark.createDataFrame([], "key string, group_id string")
    known = rounds[0].select(F.col("v").alias("key"), F.col("p").alias("group_id"))
    for minimum in rounds[1:]:
        later = minimum.select(F.col("v").alias("group_id"), F.col("p").alias("root"))
        known = known.join(later, "group_id", "left").select("key", F.coalesce("root", "group_id").alias("group_id"))
    known = scratch.keep(known, "known")
    for step, jumps in enumerate(depths):
        scratch.drop(f"low{step}_{jumps}")
    return known


def group_ids(spark: SparkSession, pool: DataFrame, edges: DataFrame) -> DataFrame:
    """The pool (with ``key``) with ``group_id``; edges that leave the pool don't count, an item without edges is its own group."""
    keys = pool.select("key")
    inside = edges.join(keys.withColumnRenamed("key", "key_a"), "key_a", "left_semi").join(keys.withColumnRenamed("key", "key_b"), "key_b", "left_semi")
    return pool.join(components(spark, inside), "key", "left").withColumn("group_id", F.coalesce("group_id", "key"))


def primary_stratum(members: DataFrame) -> DataFrame:
    """``group_id, source, class_name``: the (source, class) most members of a group have, the smallest on ties."""
    counts = members.groupBy("group_id", "source", "class_name").agg(F.count("*").alias("n"))
    order = Window.partitionBy("group_id").orderBy(F.col("n").desc(), "source", "class_name")
    return counts.withColumn("rn", F.row_number().over(order)).where("rn = 1").select("group_id", "source", "class_name")
