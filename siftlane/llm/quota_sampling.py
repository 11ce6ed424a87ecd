"""Samples that match target category proportions, from mergeable reservoirs.

One pass keeps for each stratum (a pool and a category) the rows with the smallest hash of seed and row, a bottom-k reservoir, and
counts its rows. Two reservoirs merge by keeping the k smallest of both, so every task keeps its own, of the size its stratum needs and never more than the
rows it has read, and what is shuffled doesn't grow with the pool. The k smallest hashes are a uniform sample, and so is any shorter prefix:
after the final counts each reservoir is trimmed to the quota, and categories with fewer rows than that are reported as exhausted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftlane.functions.idents import CLASSES
from siftlane.functions.ranking import place
from siftlane.session import Scratch

#: Rows that a task holds beyond its reservoirs before it trims them.
HELD = 50_000


def draw_order(seed: int, *cols: str) -> Column:
    """A seeded order that every engine reproduces."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c) for c in cols]))


def _trimmed(rows: pa.Table, strata: list[str]) -> pa.Table:
    """Of each stratum the ``k`` rows of the smallest ``spot``."""
    rows = rows.sort_by([(c, "ascending") for c in [*strata, "spot", "row_key"]]).combine_chunks()
    if not len(rows):
        return rows
    fresh = np.zeros(len(rows), bool)
    fresh[0] = True
    for c in strata:
        col = rows[c].combine_chunks()
        fresh[1:] |= pc.fill_null(pc.not_equal(col[1:], col[:-1]), False).to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(fresh)
    rank = np.arange(len(rows)) - np.repeat(starts, np.diff(np.append(starts, len(rows))))
    return rows.filter(pa.array(rank < rows["k"].to_numpy()))


def reservoirs(rows: DataFrame, strata: list[str], row_key: str, sizes: DataFrame, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(``strata, row_key, place``; ``strata, available``): the reservoir of each stratum, of the size ``k`` that ``sizes`` (``strata, k``) gives
    it, and how many rows the stratum has. Both come from one pass.

    ``row_key`` must be unique within a stratum. A stratum without a size has a count and no reservoir; rows with a NULL stratum are left out.
    ``place`` counts from 1. Places are found by ranges of the hash, so no stratum is ordered in one task.
    """
    scratch = Scratch(rows.sparkSession, "reservoir")
    known = F.lit(True)
    for c in strata:
        known = known & F.col(c).isNotNull()
    ready = rows.where(known).select(*strata, F.col(row_key).alias("row_key"), draw_order(seed, *strata, row_key).alias("spot"))
    ready = ready.join(sizes.select(*strata, F.col("k").cast("bigint")), strata, "left").select(*strata, "row_key", "spot", F.coalesce("k", F.lit(0)).cast("bigint").alias("k"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in ready.schema.fields]

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        counts: list[pa.Table] = []
        after = 0
        for b in batches:
            t = pa.Table.from_batches([b])
            counts.append(t.group_by(strata).aggregate([([], "count_all")]))
            held = t if held is None else pa.concat_tables([held, t])
            if len(held) > 2 * after + HELD:
                held = _trimmed(held, strata)
                after = len(held)
                counts = [pa.concat_tables(counts).group_by(strata).aggregate([("count_all", "sum")]).rename_columns([*strata, "count_all"])]
        if held is None:
            return
        held = _trimmed(held, strata)
        schema = pa.schema([*[pa.field(f.name, f.type) for f in held.schema], pa.field("n", pa.int64())])
        yield from held.append_column("n", pa.nulls(len(held), pa.int64())).cast(schema).to_batches()
        total = pa.concat_tables(counts)
        blank = {c: pa.nulls(len(total), held.schema.field(c).type) for c in ("row_key", "spot", "k")}
        cols = {**{c: total[c] for c in strata}, **blank, "n": total["count_all"].cast(pa.int64())}
        yield from pa.table(cols).cast(schema).to_batches()

    both = scratch.keep(ready.mapInArrow(keep, ", ".join([*fields, "n bigint"])), "kept")
    merged = place(both.where("n IS NULL").select(*strata, "row_key", "spot", "k"), strata, F.col("spot"), "row_key")
    counts = both.where("n IS NOT NULL").groupBy(*strata).agg(F.sum("n").alias("available"))
    return merged.where("place <= k").select(*strata, F.col("row_key").alias(row_key), "place"), counts


def class_weights(manifests: DataFrame) -> DataFrame:
    """``manifest_id, class_name, n, total``: the counts of the six classes, entries of one class added up.

    Repeated manifests count once; names outside the six and NULL counts don't count; a manifest without usable
    entries has no row.
    """
    once = manifests.where("manifest_id IS NOT NULL").groupBy("manifest_id").agg(F.max_by("class_counts", "remapped_at").alias("class_counts"))
    flat = once.select("manifest_id", F.explode("class_counts").alias("name", "n"))
    named = flat.select("manifest_id", F.lower(F.trim("name")).alias("class_name"), F.col("n").cast("bigint").alias("n")).where(F.col("class_name").isin(*CLASSES) & (F.col("n") > 0))
    counts = named.groupBy("manifest_id", "class_name").agg(F.sum("n").alias("n"))
    return counts.withColumn("total", F.sum("n").over(Window.partitionBy("manifest_id")))


def quotas(plans: DataFrame, weights: DataFrame) -> DataFrame:
    """``plan_id, run_id, class_name, quota``: the larger of the plan's minimum and the class's share, rounded up, in integers."""
    share = F.expr("(CAST(sample_size AS BIGINT) * n + total - 1) div total")
    plans = plans.select("plan_id", "run_id", "manifest_id", "sample_size", "min_rows")
    return plans.join(weights.select("manifest_id", "class_name", "n", "total"), "manifest_id").select(
        "plan_id", "run_id", "class_name", "n", "total", "sample_size", F.greatest(F.coalesce("min_rows", F.lit(0)).cast("bigint"), F.coalesce(share, F.lit(0).cast("bigint"))).alias("quota")
    )


def quota_report(pool_counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Each quota with what the pool has: ``available``, ``taken`` and whether the category is ``exhausted``."""
    counts = pool_counts.select("run_id", "class_name", "available")
    both = wanted.select("plan_id", "run_id", "class_name", "quota").join(counts, ["run_id", "class_name"], "left").withColumn("available", F.coalesce("available", F.lit(0).cast("bigint")))
    return both.withColumn("taken", F.least("quota", "available")).withColumn("exhausted", F.col("available") < F.col("quota"))


def draw(pool: DataFrame, wanted: DataFrame, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(``plan_id, class_name, key``; the report of `quota_report`): for each plan the reservoir of its run and class, trimmed to the quota.

    pool: ``run_id, class_name, key``, every row once; it is read once. Plans of one run draw from one reservoir, sized for the largest of their quotas.
    """
    sizes = wanted.groupBy("run_id", "class_name").agg(F.max("quota").alias("k"))
    kept, counts = reservoirs(pool, ["run_id", "class_name"], "key", sizes, seed)
    sample = wanted.select("plan_id", "run_id", "class_name", "quota").join(kept, ["run_id", "class_name"]).where("place <= quota").select("plan_id", "class_name", "key")
    return sample, quota_report(counts, wanted)
