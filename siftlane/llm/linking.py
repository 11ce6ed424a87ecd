"""Consolidating pairwise matches into groups, on a two-dimensional grid of vertex blocks.

Vertices are hashed into B blocks; an edge lies in the cell of its two blocks. Every cell is one
edge partition, in which a local union-find links what its edges link and names each vertex's
smallest local representative. A vertex occurs in the cells of one row and one column of the grid;
exchanging representatives over these gives it the smallest as parent. Parents of parents are then exchanged until they are stable: every
vertex points to a local minimum. Edges between the minima of a vertex's representatives keep together what the cells had linked. A
vertex with a smaller neighbour is no minimum, so at most half of the vertices remain each round, and the grid is hashed anew.
Following the parents over the rounds gives each vertex the smallest vertex of its component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlane.session import Scratch

#: Edges meant for one cell: a task's union-find holds these and no more.
CELL_EDGES = 200_000
MAX_ROUNDS = 60


def grid_cell(a: Column, b: Column, blocks: int, step: int = 0) -> Column:
    """The cell of an edge; the two orders of an edge share one."""
    block = lambda v: F.pmod(F.xxhash64(v, F.lit(step)), F.lit(blocks)).cast("int")
    x, y = block(a), block(b)
    return F.least(x, y) * F.lit(blocks) + F.greatest(x, y)


def local_minima(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Union-find over integer vertices below ``size``: the smallest vertex linked to each."""
    parent = np.arange(size)
    while True:
        ra, rb = parent[a], parent[b]
        low = np.minimum(ra, rb)
        before = parent.copy()
        np.minimum.at(parent, ra, low)
        np.minimum.at(parent, rb, low)
        while True:
            jump = parent[parent]
            if np.array_equal(jump, parent):
                break
            parent = jump
        if np.array_equal(parent, before):
            return parent


def _link_cell(edges: pd.DataFrame) -> pd.DataFrame:
    both = np.concatenate([edges["a"].to_numpy(dtype=object), edges["b"].to_numpy(dtype=object)])
    codes, names = pd.factorize(both, sort=True)
    half = len(edges)
    low = local_minima(codes[:half], codes[half:], len(names))
    return pd.DataFrame({"v": names, "r": np.asarray(names, dtype=object)[low]})


def _link_cells(_: tuple, edges: pd.DataFrame) -> pd.DataFrame:
    return _link_cell(edges)


def grid_components(spark: SparkSession, edges: DataFrame, a: str = "a", b: str = "b", cell_edges: int = CELL_EDGES) -> DataFrame:
    """``v, root`` for every vertex of an edge between two different vertices; root is the smallest vertex linked to it.

    Vertices are strings, compared by bytes. Edges with a NULL end and loops are left out, repeated and reversed
    edges count once, an empty table gives an empty result. A vertex with a third of all edges is spread
    over the cells of its row; a cell that would exceed ``cell_edges`` is cut by a hash of the edge, since the rounds
    need no more of a partition than that its edges are linked.
    """
    scratch = Scratch(spark, "grid")
    ends = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    current = scratch.keep(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges0")
    parents: list[DataFrame] = []
    depths: list[int] = []
    left = current.count()
    for step in range(MAX_ROUNDS):
        if not left:
            break
        blocks = max(4, math.ceil(math.sqrt(2 * left / cell_edges)))
        cells = current.select(grid_cell(F.col("a"), F.col("b"), blocks, step).alias("cell"), "a", "b")
        per_cell = cells.groupBy("cell").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
        parts = math.ceil(per_cell / cell_edges)
        spread = F.pmod(F.xxhash64("a", "b"), F.lit(parts)).cast("int")
        local = cells.withColumn("part", spread).groupBy("cell", "part").applyInPandas(_link_cells, "v string, r string")
        local = scratch.keep(local.distinct(), f"local{step}")
        parent = scratch.keep(local.groupBy("v").agg(F.min("r").alias("p")), f"parent{step}_0")
        for jump in range(1, MAX_ROUNDS):
            above = parent.select(F.col("v").alias("p"), F.col("p").alias("pp"))
            further = parent.join(above, "p").select("v", F.col("pp").alias("p"), (F.col("p") != F.col("pp")).alias("moved"))
            further = scratch.keep(further, f"parent{step}_{jump}")
            parent = further.select("v", "p")
            scratch.drop(f"parent{step}_{jump - 1}")
            if not further.where("moved").take(1):
                break
        mine, theirs = parent.withColumnRenamed("p", "x"), parent.select(F.col("v").alias("r"), F.col("p").alias("y"))
        moved = local.where("v <> r").join(mine, "v").join(theirs, "r").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        scratch.drop(f"edges{step}")
        current = scratch.keep(moved, f"edges{step + 1}")
        scratch.drop(f"local{step}")
        parents.append(parent)
        depths.append(jump)
        left = current.count()
    else:
        raise RuntimeError(f"parents are not stable after {MAX_ROUNDS} rounds")
    if not parents:
        return spark.createDataFrame([], "v string, root string")
    known = parents[0].select("v", F.col("p").alias("root"))
    for parent in parents[1:]:
        later = parent.select(F.col("v").alias("root"), F.col("p").alias("next"))
        known = known.join(later, "root", "left").select("v", F.coalesce("next", "root").alias("root"))
    known = scratch.keep(known, "known")
    for step, jumps in enumerate(depths):
        scratch.drop(f"parent{step}_{jumps}")
    scratch.drop(f"edges{len(parents)}")
    return known
