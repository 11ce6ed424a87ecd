"""Near duplicates by Hamming distance, and the greedy choice of what stays.

Items with equal hashes are collapsed first; the rest is found by multi-index hashing: a pair within distance d agrees, in one
of a few keys made of blocks of the hash, up to a few bits, so an equi-join on (key, value) finds it. Keys are made wider for more hashes. Each pair is
reported once, so no duplicates need removing. For distances above 2 that takes more work than comparing all pairs up to `ALL_PAIRS` hashes, so these are
compared by tiles: two blocks of hashes at a time, in numpy.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlane.functions.hashing import distance
from siftlane.session import Scratch

# Distances up to the first are the same item, up to the second near ones.
SAME, NEAR = 2, 8
MAX_ROUNDS = 200
# Up to so many hashes all pairs are compared for distances above SAME; hashes of a block, and pairs compared at a time.
ALL_PAIRS, BLOCK, STRIP = 1_000_000, 8192, 1 << 17
# Tiles of one task: few, since each has two blocks with their keys in an Arrow batch.
TILES = 16
# From so many hashes on, those that share keys are counted before keys are chosen.
COUNTED = 20_000


def _cuts(blocks: int) -> list[tuple[int, int]]:
    """(shift, width) of the blocks that 64 bits are cut into."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    return [(a, b - a) for a, b in pairwise(edges)]


def plan(n: int, most: int) -> tuple[int, int, int]:
    """(blocks, blocks of a key, bits of each that either side flips) for ``n`` hashes and distances up to ``most`` (11 at the most).

    A pair within the distance agrees in at least ``blocks - most`` blocks, which make a key; where that takes too many keys, flips
    stand for the bits in which blocks of a key differ: one side flips up to two bits of a single block, or both sides flip one bit of each of two
    blocks and meet at two. Wider keys mean more of them for each hash and fewer
    candidates by chance, so they pay for more hashes: the way with the fewest keys and candidates together is taken.
    """

    def cost(way: tuple[int, int, int]) -> float:
        blocks, parts, flips = way
        combos, width = math.comb(blocks, parts), 64 // blocks
        left, right = (1, 1) if not flips else (1 + width + math.comb(width, 2), 1) if parts == 1 else ((1 + width) ** parts,) * 2
        return combos * (left + right) + n * combos * left * right / 2.0 ** (width * parts)

    return min(_ways(most), key=cost)


def _ways(most: int) -> list[tuple[int, int, int]]:
    return [(most + 1, 1, 0), (most + 2, 2, 0), (most + 4, 4, 0)] if most <= 2 else [(4, 1, 1), (4, 2, 1)]


def _keys(h: Column, blocks: int, parts: int) -> list[Column]:
    """Each combination of blocks, moved together: ``combo, v``."""
    cuts, out = _cuts(blocks), []
    for c, combo in enumerate(combinations(range(blocks), parts)):
        value = F.lit(0).cast("bigint")
        for k in combo:
            value = F.shiftleft(value, cuts[k][1]).bitwiseOR(F.shiftrightunsigned(h, cuts[k][0]).bitwiseAND((1 << cuts[k][1]) - 1))
        out.append(F.struct(F.lit(c).alias("combo"), value.alias("v")))
    return out


def _counted_plan(hashes: DataFrame, n: int, most: int) -> tuple[int, int, int]:
    """`plan` for hashes that lie close together, where far more share a key than chance has it: the candidates of each way without flips are counted."""
    if most > 2 or n < COUNTED:
        return plan(n, most)
    ways = _ways(most)
    keys = [F.struct(F.lit(w).alias("way"), key.alias("key")) for w, (blocks, parts, _) in enumerate(ways) for key in _keys(F.col("h"), blocks, parts)]
    shared = hashes.select(F.explode(F.array(*keys)).alias("x")).groupBy("x").count()
    met = dict(shared.groupBy("x.way").agg(F.sum(F.col("count") * F.col("count"))).collect())
    return ways[min(met, key=lambda w: 2 * n * math.comb(*ways[w][:2]) + met[w])]


def close_pairs(hashes: DataFrame, most: int, way: tuple[int, int, int] | None = None) -> DataFrame:
    """``a, b, distance`` for all pairs of different hashes at most ``most`` (up to 11) apart, a < b as signed numbers, each once.

    hashes: ``h``, distinct. ``way``: see `plan`, which chooses it by their number. With 4 blocks and distances to 8 two blocks differ in at most two
    bits each, to 11 one does. A pair is reported by the first key and the first bits flipped by which it can be found, so nothing is
    shuffled to take repeats out.
    """
    if not 0 <= most <= 11:
        raise ValueError("distances above 11 need other keys")
    blocks, parts, flips = way or _counted_plan(hashes, hashes.count(), most)
    if flips and parts == 2 and most > 8:
        parts = 1
    cuts = _cuts(blocks)
    combos = list(combinations(range(blocks), parts))
    bits = lambda h, k: F.shiftrightunsigned(h, cuts[k][0]).bitwiseAND((1 << cuts[k][1]) - 1)

    width = cuts[0][1]
    ones = [0, *[1 << b for b in range(width)]]

    def side(name: str, masks: list[int] | None, mark: str) -> DataFrame:
        listed = hashes.select(F.col("h").alias(name), F.explode(F.array(*_keys(F.col("h"), blocks, parts))).alias("x")).select(name, "x.combo", "x.v")
        if masks is None:
            return listed
        return listed.withColumn(mark, F.explode(F.array(*[F.lit(m).cast("bigint") for m in masks]))).withColumn("v", F.col("v").bitwiseXOR(F.col(mark)))

    if not flips:
        left = right = None
    elif parts == 1:
        left, right = sorted({x | y for x in ones for y in ones}), None
    else:
        left = right = [(x << width) | y for x in ones for y in ones]
    # The planner takes a side for as small as the hashes before they are exploded, and would broadcast it.
    found = side("a", left, "m").join(side("b", right, "m2").hint("merge"), ["combo", "v"]).where("a < b")
    found = found.withColumn("distance", distance(F.col("a"), F.col("b"))).where(F.col("distance") <= most)
    differs = F.col("a").bitwiseXOR(F.col("b"))
    first = F.lit(None).cast("int")
    for c in range(len(combos) - 1, -1, -1):
        fits = F.lit(True)
        for k in combos[c]:
            fits = fits & (F.bit_count(bits(differs, k)) <= 2 * flips)
        first = F.when(fits, F.lit(c)).otherwise(first)
    found = found.where(F.col("combo") == first)
    if right is not None:
        # Of the ways to share the differing bits out to the two sides, the one in which the left side flips the highest bit of each block (and
        # neither side one that doesn't differ).
        both = F.col("m").bitwiseXOR(F.col("m2"))
        clean = F.bit_count("m") + F.bit_count("m2") == F.bit_count(both)
        for p in range(parts):
            piece = lambda c, p=p: F.shiftrightunsigned(c, p * width).bitwiseAND((1 << width) - 1)
            clean = clean & (piece(F.col("m")) >= piece(F.col("m2")))
        found = found.where(clean)
    return found.select("a", "b", "distance")


def _tiles(items: DataFrame, n: int, columns: list[str], work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``work`` over every two blocks of ``items`` (its rows: ``lo, hi`` and the blocks' columns ``x``, ``y`` as lists of structs), each two once.

    items: ``columns``, ``h`` among them, distinct in ``h``; ``n``: how many. The block of a row is drawn by its hash.
    """
    spark = items.sparkSession
    blocks = max(1, -(-n // BLOCK))
    tiles = blocks * (blocks + 1) // 2
    tasks = min(tiles, max(4 * spark.sparkContext.defaultParallelism, -(-tiles // TILES)))
    block = F.pmod(F.xxhash64("h"), F.lit(blocks)).cast("int")
    packed = Scratch(spark, "tiles").keep(items.groupBy(block.alias("block")).agg(F.collect_list(F.struct(*columns)).alias("rows")), "blocks")
    x = packed.select(F.col("block").alias("lo"), F.explode(F.sequence("block", F.lit(blocks - 1))).alias("hi"), F.col("rows").alias("x"))
    y = packed.select(F.explode(F.sequence(F.lit(0), "block")).alias("lo"), F.col("block").alias("hi"), F.col("rows").alias("y"))
    # Numbers of partitions that are asked for aren't merged: tiles have few bytes and much work. No broadcast: blocks are repeated in many tiles.
    met = x.repartition(tasks, "lo", "hi").join(y.repartition(tasks, "lo", "hi").hint("merge"), ["lo", "hi"])
    return met.mapInArrow(work, schema)


def _both(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.StructArray, pa.StructArray]]:
    """The tiles of batches: whether it is one block against itself, and the rows of its two blocks."""
    for batch in batches:
        lo, hi, x, y = (batch.column(c) for c in ("lo", "hi", "x", "y"))
        for k in range(batch.num_rows):
            yield lo[k].as_py() == hi[k].as_py(), x[k].values, y[k].values


def _hashes(rows: pa.StructArray) -> np.ndarray:
    return rows.field("h").to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64)


def _distances(a: np.ndarray, b: np.ndarray, off: int) -> Iterator[tuple[int, np.ndarray]]:
    """The first row, and distances less ``off`` (as bytes, so smaller ones wrap around to large ones), of strips of ``a`` against ``b``."""
    height = max(1, min(STRIP // max(1, len(b)), 255))
    xor, count = np.empty((height, len(b)), np.uint64), np.empty((height, len(b)), np.uint8)
    for s in range(0, len(a), height):
        k = min(height, len(a) - s)
        np.bitwise_xor(a[s : s + k, None], b, out=xor[:k])
        np.bitwise_count(xor[:k], out=count[:k])
        if off:
            np.subtract(count[:k], np.uint8(off), out=count[:k])
        yield s, count[:k]


def _listed(least: int, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Work on tiles with ``prio, key, h``: ``key_a, key_b, distance`` of pairs from ``least`` (1 at least) to ``most`` apart, key_a first by (prio, key)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for same, x, y in _both(batches):
            a, b = _hashes(x), _hashes(y)
            keys = pa.concat_arrays([x.field("key"), y.field("key")])
            prios = pa.concat_arrays([x.field("prio"), y.field("prio")])
            order = pc.sort_indices(pa.table({"p": prios, "k": keys}), sort_keys=[("p", "ascending"), ("k", "ascending")], null_placement="at_start").to_numpy()
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            for s, d in _distances(a, b, least):
                flat = d.ravel()
                at = np.flatnonzero(flat <= most - least)
                i, j = np.divmod(at, len(b))
                i += s
                if same:
                    upper = i < j
                    at, i, j = at[upper], i[upper], j[upper]
                j += len(a)
                swap = place[i] > place[j]
                first, second = np.where(swap, j, i), np.where(swap, i, j)
                if len(at):
                    yield pa.RecordBatch.from_arrays([keys.take(pa.array(first)), keys.take(pa.array(second)), pa.array(flat[at].astype(np.int32) + least)], ["key_a", "key_b", "distance"])

    return work


def _counted(least: int, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Work on tiles with ``prio, h``: ``p, q, n``, how many pairs from ``least`` (1 at least) to ``most`` apart the tile has between two priorities."""

    def runs(rows: pa.StructArray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """Hashes in the order of priorities, the priorities, where each begins."""
        codes = rows.field("prio").dictionary_encode(null_encoding="encode")
        numbers = codes.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(numbers, kind="stable")
        starts = np.searchsorted(numbers[order], np.arange(len(codes.dictionary)))
        return _hashes(rows)[order], codes.dictionary, starts

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for same, x, y in _both(batches):
            (a, p, rows), (b, q, cols) = runs(x), runs(y)
            left, right, n = [], [], []
            for k, (s, e) in enumerate(pairwise([*rows, len(a)])):
                total = np.zeros(len(b), np.int64)
                for _, d in _distances(a[s:e], b, least):
                    total += np.less_equal(d, most - least).view(np.uint8).sum(axis=0, dtype=np.uint8)  # 255 rows at the most
                counts = np.add.reduceat(total, cols)
                if same:  # the two blocks are in the same order; every pair was met from both ends
                    counts[:k] = 0
                    counts[k] //= 2
                found = np.flatnonzero(counts)
                left.append(np.full(len(found), k))
                right.append(found)
                n.append(counts[found])
            yield pa.RecordBatch.from_arrays([p.take(pa.array(np.concatenate(left))), q.take(pa.array(np.concatenate(right))), pa.array(np.concatenate(n))], ["p", "q", "n"])

    return work


def _least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Work on tiles with ``h``: the least distance of two different hashes."""
    for _, x, y in _both(batches):
        d = 1 + min(int(d.min()) for _, d in _distances(_hashes(x), _hashes(y), 1))
        if d <= 64:  # else one hash against itself
            yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32())], ["distance"])


def nearest(hashes: DataFrame, most: int) -> DataFrame:
    """``nearest``: one row with the least distance of two different hashes, NULL if that is above ``most`` (up to 11). hashes: ``h``, distinct."""
    least = F.min("distance").cast("int").alias("nearest")
    # Results are written, since a broadcast of this one row, as in a cross join, would have to end within its timeout, search and all.
    scratch = Scratch(hashes.sparkSession, "nearest")
    close = scratch.keep(close_pairs(hashes, min(most, SAME)).agg(least), "close")
    if most <= SAME or close.first()[0] is not None:
        return close
    n = hashes.count()
    if n > ALL_PAIRS:
        return scratch.keep(close_pairs(hashes, most).agg(least), "far")
    return scratch.keep(_tiles(hashes, n, ["h"], _least, "distance int").where(F.col("distance") <= most).agg(least), "far")


def greedy_dedup(spark: SparkSession, items: DataFrame) -> DataFrame:
    """``key, kept, duplicate_of, distance``: items in order (``prio``, ``key``); one within ``SAME`` of an item kept before it is dropped as a duplicate
    of the first such.

    items: ``key, prio, h``; rows without a hash are left out. An item is kept if all earlier close ones are dropped, dropped if one is kept: the rounds
    settle all items about whose earlier neighbours everything is known, until none is open. Items with equal hashes follow their first.
    """
    scratch = Scratch(spark, "dedup")
    rows = items.where("h IS NOT NULL").select("key", "prio", "h", F.struct("prio", "key").alias("place"))
    rows = scratch.keep(rows, "rows")
    heads = scratch.keep(rows.groupBy("h").agg(F.min("place").alias("place")), "heads")
    pairs = close_pairs(heads.select("h"), SAME)
    pa = heads.select(F.col("h").alias("a"), F.col("place").alias("place_a"))
    pb = heads.select(F.col("h").alias("b"), F.col("place").alias("place_b"))
    sided = pairs.join(pa, "a").join(pb, "b")
    first = F.col("place_a") < F.col("place_b")
    edges = sided.select(F.when(first, F.col("b")).otherwise(F.col("a")).alias("later"), F.when(first, F.col("a")).otherwise(F.col("b")).alias("earlier"), "distance")
    all_edges = scratch.keep(edges, "edges")
    active, step = all_edges, 0
    kept = scratch.keep(heads.select("h").join(all_edges.select(F.col("later").alias("h")), "h", "left_anti"), "kept0")
    known_kept = [kept]
    while active.take(1):
        step += 1
        if step > MAX_ROUNDS:
            raise RuntimeError("the order of near duplicates is deeper than expected")
        dropped = active.join(kept.select(F.col("h").alias("earlier")), "earlier", "left_semi").select("later").distinct()
        dropped = scratch.keep(dropped, f"dropped{step}")
        # A dropped item has no say: its edges go, on both sides.
        rest = active.join(dropped, "later", "left_anti").join(dropped.withColumnRenamed("later", "earlier"), "earlier", "left_anti")
        rest = scratch.keep(rest.select("later", "earlier", "distance"), f"rest{step}")
        open_before = active.select("later").distinct().join(dropped, "later", "left_anti")
        kept = scratch.keep(open_before.join(rest.select("later"), "later", "left_anti").select(F.col("later").alias("h")), f"kept{step}")
        known_kept.append(kept)
        active = rest
    every = known_kept[0]
    for more in known_kept[1:]:
        every = every.unionByName(more)
    every = scratch.keep(every, "kept")
    for k in range(step + 1):
        scratch.drop(f"kept{k}")
        scratch.drop(f"dropped{k}")
        scratch.drop(f"rest{k}")
    by = heads.select(F.col("h").alias("earlier"), F.col("place").alias("by_place"))
    choice = all_edges.join(every.select(F.col("h").alias("earlier")), "earlier", "left_semi").join(by, "earlier")
    choice = choice.groupBy(F.col("later").alias("h")).agg(F.min_by(F.struct("by_place.key", "distance"), "by_place").alias("c"))
    states = heads.join(every.withColumn("is_kept", F.lit(True)), "h", "left").join(choice, "h", "left")
    head_kept = F.coalesce("is_kept", F.lit(False))
    is_head = F.col("key") == F.col("head.key")
    joined = rows.select("key", "h").join(states.select("h", F.col("place").alias("head"), "is_kept", "c"), "h")
    return joined.select(
        "key",
        (head_kept & is_head).alias("kept"),
        F.when(head_kept & ~is_head, F.col("head.key")).when(~head_kept, F.col("c.key")).alias("duplicate_of"),
        F.when(head_kept & ~is_head, F.lit(0)).when(~head_kept, F.col("c.distance")).cast("int").alias("distance"),
    )


def near_edges(kept: DataFrame) -> DataFrame:
    """``key_a, key_b, distance`` for kept items 3 to 8 apart; key_a is the earlier. kept: ``key, prio, h`` with distinct hashes."""
    kept = Scratch(kept.sparkSession, "near").keep(kept.select("key", "prio", "h").where("h IS NOT NULL"), "kept")
    n = kept.count()
    if n <= ALL_PAIRS:
        key = kept.schema["key"].dataType.simpleString()
        return _tiles(kept, n, ["key", "prio", "h"], _listed(SAME + 1, NEAR), f"key_a {key}, key_b {key}, distance int")
    pairs = close_pairs(kept.select("h"), NEAR).where(F.col("distance") > SAME)
    a = kept.select(F.col("h").alias("a"), F.struct("prio", "key").alias("pa"))
    b = kept.select(F.col("h").alias("b"), F.struct("prio", "key").alias("pb"))
    both = pairs.join(a, "a").join(b, "b")
    return both.select(F.least("pa", "pb")["key"].alias("key_a"), F.greatest("pa", "pb")["key"].alias("key_b"), F.col("distance").cast("int").alias("distance"))


def near_matrix(kept: DataFrame) -> DataFrame:
    """How many of the near edges each two sources have, where ``prio`` is the source: ``left_source, right_source, n``, the earlier one left.

    kept: ``key, prio, h`` with distinct hashes. Edges are counted tile by tile and not listed.
    """
    kept = Scratch(kept.sparkSession, "near").keep(kept.select("key", "prio", "h").where("h IS NOT NULL"), "kept")
    n = kept.count()
    if n > ALL_PAIRS:
        return source_matrix(near_edges(kept), kept.select("key", F.col("prio").alias("source")), "key_a", "key_b")
    prio = kept.schema["prio"].dataType.simpleString()
    counts = _tiles(kept, n, ["prio", "h"], _counted(SAME + 1, NEAR), f"p {prio}, q {prio}, n bigint")
    p, q = F.struct(F.col("p").alias("s")), F.struct(F.col("q").alias("s"))
    return counts.groupBy(F.least(p, q)["s"].alias("left_source"), F.greatest(p, q)["s"].alias("right_source")).agg(F.sum("n").alias("n"))


def source_matrix(pairs: DataFrame, sources: DataFrame, left: str, right: str) -> DataFrame:
    """How many pairs each two sources have: ``left_source, right_source, n``. sources: ``key, source``."""
    a = sources.select(F.col("key").alias(left), F.col("source").alias("left_source"))
    b = sources.select(F.col("key").alias(right), F.col("source").alias("right_source"))
    return pairs.join(a, left).join(b, right).groupBy("left_source", "right_source").agg(F.count("*").alias("n"))


def unknown_sources(items: DataFrame, priorities: DataFrame) -> DataFrame:
    return items.select("source").distinct().join(priorities.select("source"), "source", "left_anti")
