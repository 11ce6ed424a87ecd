"""Caps on classes that never wipe out a source."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftlane.functions.hashing import rank_hash
from siftlane.functions.ranking import place, twister_sample


def hash_sample(items: DataFrame, strata: list[str], n: str, purpose: str, seed: int = 42) -> DataFrame:
    """At most ``n`` (a column, the same within a stratum) items of each stratum, without replacement, in the seeded order of their keys.

    Ties of the hash are broken by key. A stratum of any size is ranked over many tasks.
    """
    label = F.concat_ws(":", F.lit(purpose), *[F.col(c) for c in strata])
    return place(items, strata, rank_hash(seed, label, F.col("key")), "key", "_place").where(F.col("_place") <= F.col(n)).drop("_place")


def allocate(pools: DataFrame, cap: int) -> DataFrame:
    """``class_name, source, size, take``: the cap of a class over its sources.

    pools: ``class_name, source, size``. A class within the cap keeps everything. Else each source gets the whole part of its proportion; one at
    least where the cap allows one for each; what remains goes to the sources in order of the fractional part, each up to its size. The
    least of one is given after the parts, so the sum may exceed the cap.
    """
    by_class = Window.partitionBy("class_name")
    q = pools.withColumn("total", F.sum("size").over(by_class)).withColumn("sources", F.count("*").over(by_class))
    q = q.withColumn("quota", F.lit(cap) * F.col("size") / F.col("total")).withColumn("base", F.floor("quota").cast("bigint"))
    q = q.withColumn("given", F.when((F.col("sources") <= cap) & (F.col("base") == 0) & (F.col("size") > 0), F.lit(1).cast("bigint")).otherwise(F.least("base", "size")))
    q = q.withColumn("room", F.col("size") - F.col("given")).withColumn("remaining", F.lit(cap) - F.sum("given").over(by_class))
    before = by_class.orderBy((F.col("quota") - F.col("base")).desc(), "source").rowsBetween(Window.unboundedPreceding, -1)
    spent = F.coalesce(F.sum("room").over(before), F.lit(0))
    more = F.least(F.col("room"), F.greatest(F.col("remaining") - spent, F.lit(0)))
    return q.withColumn("more", more).select("class_name", "source", "size", F.when(F.col("total") <= cap, F.col("size")).otherwise(F.col("given") + F.col("more")).cast("bigint").alias("take"))


def balance(items: DataFrame, cap: int, seed: int = 42, exempt: list[str] | None = None, source_caps: DataFrame | None = None, generator: str = "hash") -> DataFrame:
    """items (``key, class_name, source``) with ``kept``.

    ``generator``: ``hash``, or ``twister`` for the picks of Python's generator (see `twister_sample`). Exempt sources keep everything. source_caps: ``source, class_name, source_cap``, applied before the class cap.
    """
    if cap <= 0:
        raise ValueError("cap must be positive")
    free = F.col("source").isin(exempt or [])
    pool = items.where(~free)
    counts = pool.groupBy("class_name", "source").agg(F.count("*").alias("all_items"))
    if source_caps is not None:
        counts = counts.join(source_caps, ["source", "class_name"], "left")
    else:
        counts = counts.withColumn("source_cap", F.lit(None).cast("int"))
    counts = counts.withColumn("size", F.least("all_items", F.coalesce("source_cap", "all_items")).cast("bigint"))
    takes = allocate(counts.select("class_name", "source", "size"), cap)
    sized = pool.join(takes, ["class_name", "source"])
    strata = ["class_name", "source"]
    if generator == "twister":
        first = twister_sample(sized, strata, "size", "srccap", "key", seed)
        chosen = twister_sample(first, strata, "take", "cap", "key", seed)
    else:
        chosen = hash_sample(hash_sample(sized, strata, "size", "srccap", seed), strata, "take", "cap", seed)
    kept = chosen.select("key", F.lit(True).alias("chosen"))
    return items.join(kept, "key", "left").select("key", "class_name", "source", (free | F.coalesce("chosen", F.lit(False))).alias("kept"))


def balance_counts(balanced: DataFrame) -> DataFrame:
    return balanced.groupBy("class_name", "source").agg(F.count_if("kept").alias("kept"), F.count_if(~F.col("kept")).alias("dropped"))


def below_floor(balanced: DataFrame, floor: int) -> DataFrame:
    """Classes of fewer kept items than ``floor``."""
    return balanced.groupBy("class_name").agg(F.count_if("kept").alias("kept")).where(F.col("kept") < floor)


def review_sample(items: DataFrame, strata: list[str], fraction: float, seed: int = 42, purpose: str = "review") -> DataFrame:
    """``ceil(fraction * n)`` items of each stratum."""
    counts = items.groupBy(*strata).agg(F.ceil(F.count("*") * F.lit(float(fraction)) - 1e-9).cast("bigint").alias("wanted"))
    return hash_sample(items.join(counts, strata), strata, "wanted", purpose, seed).drop("wanted")
