"""The N best rows of every group, by descending score bands.

The rows are staged once, range-partitioned by score band; the bands are quantiles of the score. Bands are taken from the top: within a band
every group keeps its first N rows by the exact order, groups that higher bands have filled are
anti-joined away before anything of theirs is shuffled or ranked, and a group that higher bands have filled in part takes only what it lacks. Equal
scores share a band, so ties never cross a boundary and the order inside a band settles them.

The anti-join is a broadcast of the filled groups, or a semi-join with the groups that are still open, where the smaller of the two has at most
``LISTED`` keys by count; beyond that hot groups (more than 1/``HOT`` of all rows, so fewer than ``HOT``) go by a broadcast, and the others by a
shuffled anti-join, which no hot key burdens.

Hot groups: rows that are the same item are merged by a partial aggregation before any shuffle, on
a hash of the whole order, which spreads a hot group; the ranking then sends at most N rows of a
group per task to one place: the rank limit runs before its shuffle, by itself up to Spark's ``RANKED``, and over hashed parts of a
group beyond that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftlane.session import Scratch

HOT, LISTED = 1000, 500_000
#: Largest N for which Spark limits ranks before their shuffle, and rows of a group in one part for larger ones.
RANKED, PART_ROWS = 1000, 500_000


def band_edges(scored: DataFrame, score: str, bands: int) -> list[float]:
    """Lower edges of at most ``bands`` bands of about equal row counts, from the top; the last is minus infinity. One pass."""
    if bands < 2:
        return [float("-inf")]
    cuts, low = scored.agg(F.percentile_approx(score, [1 - k / bands for k in range(1, bands)], 10_000), F.min(score)).first()
    return [*sorted({float(c) for c in cuts or () if c > low}, reverse=True), float("-inf")]


def top_n(
    spark: SparkSession,
    rows: DataFrame,
    group: str,
    score: str,
    ties: Sequence[str],
    row_id: str,
    n: int = 3,
    bands: int = 4,
) -> DataFrame:
    """``group, score, ties, row_id, rank``: the first ``n`` items of each group by score descending, then ``ties`` ascending.

    Rows equal in group, score and all ties are one item, shown by its smallest ``row_id``. Rows with
    a NULL group, a NULL or NaN score are left out; NULL ties come first. A group with fewer than ``n`` items keeps
    what it has, an empty input gives an empty result. Other columns of ``rows`` are not read.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    scratch = Scratch(spark, "top")
    cols = [group, score, *ties]
    scored = rows.where(F.col(score).isNotNull() & ~F.isnan(score))
    edges = band_edges(scored.select(score), score, bands)
    clean = scored.select(*cols, row_id).where(F.col(group).isNotNull())
    band_of = F.lit(len(edges) - 1)
    for b in range(len(edges) - 2, -1, -1):
        band_of = F.when(F.col(score) >= F.lit(edges[b]), F.lit(b)).otherwise(band_of)
    staged = scratch.keep(clean.withColumn("band", band_of.cast("int")), "rows", partition_by="band")
    sizes = scratch.keep(staged.groupBy(group).agg(F.count("*").alias("rows_of_group")), "sizes")
    groups, everything, largest = sizes.agg(F.count("*"), F.sum("rows_of_group"), F.max("rows_of_group")).first()
    hot = sizes.where(F.col("rows_of_group") > (everything or 0) / HOT).select(group)
    parts = -(-(largest or 0) // PART_ROWS) if n > RANKED else 1

    order = [F.col(score).desc(), *[F.col(t).asc_nulls_first() for t in ties]]
    full: DataFrame | None = None  # group, have: what higher bands gave
    results: list[DataFrame] = []
    for b in range(len(edges)):
        band = staged.where(F.col("band") == b)
        if full is not None:
            done = full.where(F.col("have") >= n).select(group)
            closed = done.count()
            if closed <= LISTED:
                band = band.join(F.broadcast(done), group, "left_anti")
            elif groups - closed <= LISTED:
                band = band.join(F.broadcast(sizes.select(group).join(done, group, "left_anti")), group, "left_semi")
            else:
                band = band.join(F.broadcast(hot.join(done, group, "left_semi")), group, "left_anti").join(done, group, "left_anti")
        items = band.groupBy(*cols).agg(F.min(row_id).alias(row_id))
        if parts > 1:
            inside = Window.partitionBy(group, "part").orderBy(*order)
            items = items.withColumn("part", F.pmod(F.xxhash64(row_id), F.lit(parts))).withColumn("place", F.row_number().over(inside)).where(F.col("place") <= n).drop("part", "place")
        ranked = items.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rank") <= n)
        if full is not None:
            ranked = (
                ranked.join(full, group, "left")
                .withColumn("rank", F.col("rank") + F.coalesce("have", F.lit(0)).cast("int"))
                .where(F.col("rank") <= n)
                .drop("have")
            )
        taken = scratch.keep(ranked.select(*cols, row_id, "rank"), f"band{b}")
        results.append(taken)
        if b + 1 < len(edges):
            counts = taken.groupBy(group).agg(F.max("rank").alias("have"))
            if full is not None:
                counts = full.unionByName(counts).groupBy(group).agg(F.max("have").alias("have"))
            full = scratch.keep(counts, f"full{b}")
    for name in ["rows", "sizes", *[f"full{b}" for b in range(len(edges) - 1)]]:
        scratch.drop(name)
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
