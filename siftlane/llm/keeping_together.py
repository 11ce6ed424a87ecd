"""Splits that keep related records together.

What ties records is any number of columns (author, source, entity, group): records with an equal value in one of them belong together. Each value
is a hub. A record is hooked to the smallest hub it has, so what is left to contract are edges between hubs, of the records that have
several; stars, however large, cost one pass.

Components of the hubs by random-mate contraction: each round every vertex flips a coin (a hash of vertex and
round, so a retried task flips alike). A tail vertex with a head neighbour moves into its smallest
one; joins put the new names into the edges, loops and repeats go. On average a quarter or more of the
vertices that have edges move each round, until no edges remain. The moves of all rounds are then unwound, last first, to
give every vertex its label.

Components are then laid out in a hashed order and cut where the running weight reaches the shares.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlane.functions.idents import item_ident, plain_name, source_of_ident, split_name
from siftlane.functions.ranking import running_sum
from siftlane.session import Scratch

MAX_ROUNDS = 200


def _heads(vertex: Column, step: int) -> Column:
    return F.substring(F.md5(F.concat_ws("|", F.lit("mate"), F.lit(str(step)), vertex)), 1, 1) < "8"


def random_mate_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``v, root`` for every vertex of the edge table ``a, b``; vertices of one component share a root, itself one of them.

    NULL ends and loops are left out, repeats and reversals count once; no edges, no rows. A vertex with very many
    edges is no hot key while it shows heads (those edges need no join on it); in tails its edges are joined with one row, which
    adaptive execution splits by the edge side. The choice of a mate is a minimum, combined before the shuffle.
    """
    scratch = Scratch(spark, "mate")
    ends = edges.select(F.col("a").alias("x"), F.col("b").alias("y")).where("x <> y")
    current = scratch.keep(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges0")
    left = bool(current.take(1))
    moves: list[DataFrame] = []
    for step in range(MAX_ROUNDS):
        if not left:
            break
        heads_a, heads_b = _heads(F.col("a"), step), _heads(F.col("b"), step)
        # The mixed edges, as (tail, head).
        mates = current.where(heads_a != heads_b).select(F.when(heads_a, F.col("b")).otherwise(F.col("a")).alias("v"), F.when(heads_a, F.col("a")).otherwise(F.col("b")).alias("to"))
        move = scratch.keep(mates.groupBy("v").agg(F.min("to").alias("to")), f"move{step}")
        new = current
        for end in ("a", "b"):
            stays = new.where(_heads(F.col(end), step))
            may_move = new.where(~_heads(F.col(end), step)).join(move, F.col(end) == F.col("v"), "left")
            renamed = may_move.withColumn(end, F.coalesce("to", end)).drop("v", "to")
            new = stays.unionByName(renamed)
        new = new.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        current = scratch.keep(new, f"edges{step + 1}")
        scratch.drop(f"edges{step}")
        moves.append(move)
        left = bool(current.take(1))
    else:
        raise RuntimeError(f"edges remain after {MAX_ROUNDS} rounds")
    if not moves:
        return spark.createDataFrame([], "v string, root string")
    # Unwind: a vertex that moved in round k has the label of the vertex it moved into, which may have moved later.
    labels = moves[-1].select("v", F.col("to").alias("root"))
    for step in range(len(moves) - 2, -1, -1):
        later = labels.select(F.col("v").alias("to"), "root")
        mine = moves[step].join(later, "to", "left").select("v", F.coalesce("root", "to").alias("root"))
        labels = labels.unionByName(mine)
        labels = scratch.keep(labels, f"labels{step}")
        scratch.drop(f"move{step}")
        scratch.drop(f"labels{step + 1}")
    roots = labels.select(F.col("root").alias("v"), "root").distinct()
    return labels.unionByName(roots)


def tied_components(spark: SparkSession, rows: DataFrame, ties: Sequence[str], record: str, within: str | None = None) -> DataFrame:
    """``rows`` with ``component``: the smallest ``record`` of all that are tied to a row, directly or through others.

    ties: columns; rows with an equal value in one of them are tied (a value of one column has nothing to do with the same value of
    another), a NULL ties nothing. ``record`` names a row and must not be NULL; with ``within`` only rows with the same value there are tied. A value that a third of all rows share
    is no hot key: its rows are hooked where they are, and what is shuffled for them is combined first.
    """
    scratch = Scratch(spark, "tied")
    spaces = [F.col(within)] if within else []
    hubs = F.array_compact(F.array(*[F.when(F.col(t).isNotNull(), F.concat_ws("|", F.lit(str(k)), *spaces, F.col(t).cast("string"))) for k, t in enumerate(ties)]))
    ready = scratch.keep(rows.withColumn("_hubs", hubs).withColumn("_hub", F.array_min("_hubs")), "rows")
    several = ready.where(F.size("_hubs") > 1).select(F.col("_hub").alias("a"), F.explode("_hubs").alias("b"))
    roots = random_mate_components(spark, several)
    linked = ready.join(roots.select(F.col("v").alias("_hub"), F.col("root").alias("_root")), "_hub", "left")
    linked = linked.withColumn("_root", F.coalesce("_root", "_hub"))
    names = linked.where("_root IS NOT NULL").groupBy("_root").agg(F.min(record).alias("_name"))
    named = linked.join(names, "_root", "left").withColumn("component", F.coalesce("_name", record))
    return named.drop("_hubs", "_hub", "_root", "_name")


def cumulative_cut(components: DataFrame, shares: Mapping[str, float], seed: int = 42, within: str | None = None) -> DataFrame:
    """``components`` (``root, weight`` and, if named, ``within``) with a ``split``: hashed order, cut by running weight.

    A component goes where the middle of its own weight lies, so no share is off by more than half of one component at each cut. The
    running sum is taken over ranges of the hash: their totals are a small table, and only within a
    range are rows ordered. Shares must be positive and add up to 1. With ``within``, each of its values is cut by itself.
    """
    if not shares or min(shares.values()) <= 0 or abs(sum(shares.values()) - 1) > 1e-9:
        raise ValueError("shares must be positive and add up to 1")
    key = within or "_all"
    ready = components if within else components.withColumn("_all", F.lit(0))
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), "root"))
    placed = running_sum(ready, [key], digest, "root", F.col("weight"), "_before")
    totals = ready.groupBy(key).agg(F.sum("weight").alias("_total"))
    middle = (F.col("_before") + F.col("weight") / 2) / F.col("_total")
    split, edge = None, 0.0
    for name, share in shares.items():
        edge += share
        below = F.col("_middle") < edge - 1e-12
        split = F.when(below, F.lit(name)) if split is None else split.when(below, F.lit(name))
    cut = placed.join(totals, key).withColumn("_middle", middle).withColumn("split", split.otherwise(F.lit(list(shares)[-1])))
    return cut.drop("_before", "_total", "_middle", "_all")


def keep_together(spark: SparkSession, rows: DataFrame, ties: Sequence[str], record: str, shares: Mapping[str, float], seed: int = 42) -> DataFrame:
    """``record, component, split`` for every row: splits of given shares in which rows that share a value in a column of ``ties`` stay together."""
    tied = Scratch(spark, "together").keep(tied_components(spark, rows.select(record, *ties), ties, record), "tied")
    sizes = tied.groupBy(F.col("component").alias("root")).agg(F.count("*").alias("weight"))
    cut = cumulative_cut(sizes, shares, seed)
    return tied.join(cut.select(F.col("root").alias("component"), "split"), "component").select(record, "component", "split")


def current_assignments(results: DataFrame, items: DataFrame) -> DataFrame:
    """``run_id, ident, key, source, split, group, leave_out``: for a run and an item the row with the latest ``assigned_at``.

    results: ``run_id, key, split, group_id, leave_out_source, assigned_at`` in any spelling; items: ``ident, key``. Rows that
    name no item, and rows without run or split, are left out; a NULL or blank group means none. The latest row is found by a
    combinable maximum, so repeated and superseded rows are gone before the shuffle.
    """
    rows = results.select(
        "run_id",
        item_ident(F.col("key")).alias("ident"),
        F.struct(
            F.col("assigned_at"),
            split_name(F.col("split")).alias("split"),
            item_ident(F.col("group_id")).alias("group"),
            plain_name(F.col("leave_out_source")).alias("leave_out"),
        ).alias("now"),
    ).where("run_id IS NOT NULL AND ident IS NOT NULL AND now.split IS NOT NULL")
    latest = rows.groupBy("run_id", "ident").agg(F.max("now").alias("now"))
    return latest.join(items.select("ident", "key"), "ident").select(
        "run_id", "ident", "key", source_of_ident(F.col("ident")).alias("source"), "now.split", "now.group", "now.leave_out"
    )


def broken_ties(spark: SparkSession, current: DataFrame) -> DataFrame:
    """``run_id, key`` of the assignments that break a tie.

    Broken is a component of items tied by their groups whose items lie in several splits; an item of the left-out source outside
    test; an item of another source in test.
    """
    rows = current.select("run_id", "key", "source", "split", "group", "leave_out")
    tied = Scratch(spark, "ties").keep(tied_components(spark, rows, ["group"], "key", "run_id"), "tied")
    torn = tied.groupBy("run_id", "component").agg(F.min("split").alias("low"), F.max("split").alias("high")).where("low <> high").select("run_id", "component", F.lit(True).alias("torn"))
    ours = F.col("source").eqNullSafe(F.col("leave_out"))
    return (
        tied.join(torn, ["run_id", "component"], "left")
        .where(F.coalesce("torn", F.lit(False)) | (ours & (F.col("split") != "test")) | (~ours & (F.col("split") == "test")))
        .select("run_id", "key")
    )


def assign_splits(spark: SparkSession, current: DataFrame, shares: Mapping[str, float] | None = None, test_share: float = 0.15, seed: int = 42, ties: Sequence[str] = ("group",)) -> DataFrame:
    """``run_id, key, source, component, weight, split``: new splits in which whatever is tied stays together.

    ties: columns of ``current`` that tie items of a run; its left-out source does so too. That source and everything tied to it become
    test; the other components are cut into ``shares`` (train and val). A run without a left-out source also gets a test part of ``test_share``.
    """
    shares = dict(shares or {"train": 0.85, "val": 0.15})
    rows = current.select("run_id", "key", "source", "leave_out", *ties).withColumn("_held", F.when(F.col("source") == F.col("leave_out"), F.col("source")))
    tied = Scratch(spark, "assign").keep(tied_components(spark, rows, [*ties, "_held"], "key", "run_id"), "tied")
    sizes = tied.groupBy("run_id", F.col("component").alias("root")).agg(
        F.count("*").alias("weight"), F.max(F.col("_held").isNotNull()).alias("held"), F.max(F.col("leave_out").isNotNull()).alias("leaves")
    )
    held = sizes.where("held").withColumn("split", F.lit("test"))
    two = cumulative_cut(sizes.where("NOT held AND leaves"), shares, seed, "run_id")
    rest = {name: share * (1 - test_share) for name, share in shares.items()}
    three = cumulative_cut(sizes.where("NOT held AND NOT leaves"), {**rest, "test": test_share}, seed, "run_id")
    cols = ["run_id", "root", "weight", "split"]
    placed = held.select(*cols).unionByName(two.select(*cols)).unionByName(three.select(*cols)).withColumnRenamed("root", "component")
    return tied.join(placed, ["run_id", "component"]).select("run_id", "key", "source", "component", "weight", "split")
