"""The best representative of each duplicate group, built from consistent bundles.

Fields that depend on one another (a label with the item it was drawn for; a confidence with the record, method and time it belongs
to) form a bundle, which is taken whole from one member or not at all. A candidate of a bundle has a
rank by the trust in it and *determinants*: values that functional dependencies between bundles compare (two bundles that name the same
determinant must agree on it).

For a group, branch and bound picks one candidate per bundle. Bundles have a level of importance: no gain in a lower level makes
up for a loss in a higher one, within a level costs add up. Bundles are taken in order of importance, candidates from the most
trusted; a branch is cut when its costs plus the least costs of the open bundles can't beat the best found. Only the
most trusted candidate of each distinct determinant tuple can be part of an optimum, so only these leave the
aggregation: a group of any size sends its few distinct determinants to a task, never its members.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlane.functions.idents import class_of_key, has_label, item_ident, source_of_ident
from siftlane.session import ship_package

#: Cost of leaving a bundle empty; more than any rank of its level.
EMPTY = 1 << 40


def branch_and_bound(bundles: Sequence[Sequence[tuple[int, Mapping[str, str | None]]]], levels: Sequence[int] | None = None) -> list[int | None]:
    """For each bundle the position of the chosen candidate, None where none fits; candidates are (rank, determinants).

    levels: the level of each bundle from 0, by default all 0. Minimises the sums of ranks level by level, of equal sums the one that is better in
    the earlier bundle. A NULL determinant agrees with everything.
    """
    n = len(bundles)
    level = list(levels or [0] * n)
    depth = max(level, default=0) + 1
    order = [sorted(range(len(b)), key=lambda i, b=b: b[i][0]) for b in bundles]
    # What the bundles from k on cost at least, level by level.
    least = [(0,) * depth]
    for k in range(n - 1, -1, -1):
        least.append(_added(least[-1], level[k], min([EMPTY, *(bundles[k][i][0] for i in order[k][:1])])))
    least.reverse()
    best: list = [None, [None] * n]

    def descend(k: int, cost: tuple[int, ...], taken: list, known: dict) -> None:
        if best[0] is not None and tuple(map(sum, zip(cost, least[k], strict=True))) >= best[0]:
            return
        if k == n:
            best[:] = [cost, list(taken)]
            return
        for i in order[k]:
            rank, det = bundles[k][i]
            if any(v is not None and known.get(d, v) != v for d, v in det.items()):
                continue
            descend(k + 1, _added(cost, level[k], rank), [*taken, i], known | {d: v for d, v in det.items() if v is not None})
        descend(k + 1, _added(cost, level[k], EMPTY), [*taken, None], known)

    descend(0, (0,) * depth, [], {})
    return best[1]


def _added(cost: tuple[int, ...], level: int, rank: int) -> tuple[int, ...]:
    return (*cost[:level], cost[level] + rank, *cost[level + 1 :])


def best_representative(candidates: DataFrame, bundles: Sequence[str], levels: Mapping[str, int] | None = None) -> DataFrame:
    """``group, bundle, candidate``: the bundles chosen for each group; a bundle that stays empty has no row.

    candidates: ``group, bundle, trust, determinants, candidate``; ``trust`` is any orderable value of which smaller is
    more trusted, equal within a bundle only for interchangeable candidates; ``determinants`` a map from string to string (empty
    or NULL: unconstrained); ``candidate`` a string that names the source of the bundle. Rows without group or candidate are
    left out. ``levels``: see `branch_and_bound`. The trust is turned into ranks among the few candidates that survive the aggregation; determinants
    should be columns of few values in a group (a class, a source's priority), since each distinct tuple is an option.
    """
    ship_package(candidates.sparkSession)
    names, level = list(bundles), [(levels or {}).get(b, 0) for b in bundles]
    rows = candidates.select("group", "bundle", "trust", "determinants", "candidate").where(F.col("group").isNotNull() & F.col("candidate").isNotNull())
    det = F.to_json(F.map_from_entries(F.array_sort(F.map_entries(F.coalesce("determinants", F.create_map().cast("map<string,string>"))))))
    kept = rows.withColumn("det", det).groupBy("group", "bundle", "det").agg(F.min(F.struct("trust", "candidate")).alias("top"))
    options = kept.groupBy("group", "bundle").agg(F.sort_array(F.collect_list(F.struct("top", "det"))).alias("o"))
    slim = options.select("group", "bundle", F.col("o.top.candidate").alias("candidates"), F.col("o.det").alias("dets"))
    per_group = slim.groupBy("group").agg(F.collect_list(F.struct("bundle", "candidates", "dets")).alias("b"))

    def choose(batches):
        import json

        for pdf in batches:
            out = []
            for group, rows_ in zip(pdf["group"], pdf["b"], strict=True):
                by = {r["bundle"]: r for r in rows_}
                lists = [[(i, json.loads(d)) for i, d in enumerate(by[b]["dets"])] if b in by else [] for b in names]
                for b, pick in zip(names, branch_and_bound(lists, level), strict=True):
                    if pick is not None:
                        out.append((group, b, by[b]["candidates"][pick]))
            yield pd.DataFrame(out, columns=["group", "bundle", "candidate"])

    return per_group.mapInPandas(choose, "group string, bundle string, candidate string")


def duplicate_members(dropped: DataFrame, items: DataFrame) -> DataFrame:
    """``group_key, key, ident``: each kept item and all items dropped for it, once.

    dropped: ``key, duplicate_of`` in any spelling; items: ``ident, key``. A drop for something that is no item forms no group; a
    dropped key that is no item is no member; an item dropped for several kept items is a member of each group.
    """
    pairs = dropped.select(item_ident(F.col("duplicate_of")).alias("kept"), item_ident(F.col("key")).alias("gone")).where("kept IS NOT NULL").distinct()
    items = items.select("ident", "key")
    kept = pairs.select("kept").distinct().join(items, F.col("kept") == F.col("ident")).select("kept", F.col("key").alias("group_key"))
    both = pairs.where("gone IS NOT NULL").unionByName(pairs.select("kept", F.col("kept").alias("gone"))).distinct()
    named = both.join(kept, "kept").join(items, F.col("gone") == F.col("ident"))
    return named.select("group_key", "key", "ident").distinct()


def label_candidates(members: DataFrame, items: DataFrame, specs: DataFrame) -> DataFrame:
    """Candidates for the bundles ``priority`` and ``label``: members with a label.

    A key determines its source, and the source its priority: the best priority is chosen first, then the smallest key of that priority. items
    are item rows (``key, label``); any row's label counts. A source without a priority comes last.
    """
    labelled = items.where(has_label(F.col("label"))).select(item_ident(F.col("key")).alias("ident")).distinct()
    ranks = specs.select(F.regexp_replace(F.lower(F.trim("source")), r"[\s_]+", "-").alias("source"), "priority").where("source IS NOT NULL").groupBy("source").agg(F.min("priority").alias("priority"))
    with_label = members.select("group_key", "key", "ident").join(labelled, "ident").withColumn("source", source_of_ident(F.col("ident"))).join(ranks, "source", "left")
    first = F.coalesce("priority", F.lit(2**31 - 1))
    trust = lambda value, text: F.struct(value.cast("double").alias("first"), F.lit(0.0).alias("second"), text.alias("third"))
    bundles = F.array(
        F.struct(F.lit("priority").alias("bundle"), trust(first, F.lit("")).alias("trust"), first.cast("string").alias("candidate")),
        F.struct(F.lit("label").alias("bundle"), trust(F.lit(0), F.col("key")).alias("trust"), F.col("key").alias("candidate")),
    )
    listed = with_label.select(F.col("group_key").alias("group"), F.explode(bundles).alias("b"), first.cast("string").alias("priority"), class_of_key(F.col("key")).alias("class"))
    return listed.select("group", "b.bundle", "b.trust", "b.candidate", "priority", F.when(F.col("b.bundle") == "label", F.col("class")).alias("class"))


def box_candidates(members: DataFrame, records: DataFrame) -> DataFrame:
    """Candidates for the box bundle: records of members with a confidence above 0 and at most 1, NaN and NULL are none.

    Trust: the latest ``boxed_at`` (NULL last), then the larger confidence, then the smaller record_id.
    """
    usable = records.where("confidence > 0 AND confidence <= 1 AND NOT isnan(confidence) AND record_id IS NOT NULL").select(
        item_ident(F.col("image")).alias("ident"), "record_id", "confidence", "boxed_at"
    )
    trust = F.struct(
        F.coalesce(-F.unix_micros(F.col("boxed_at").cast("timestamp")).cast("double"), F.lit(float("inf"))).alias("first"),
        (-F.col("confidence")).alias("second"),
        F.lpad(F.col("record_id").cast("string"), 20, "0").alias("third"),
    )
    found = members.select("group_key", "key", "ident").join(usable, "ident")
    return found.select(F.col("group_key").alias("group"), F.lit("box").alias("bundle"), trust.alias("trust"), F.col("record_id").cast("string").alias("candidate"), F.lit(None).cast("string").alias("priority"), class_of_key(F.col("key")).alias("class"))


def representatives(members: DataFrame, items: DataFrame, specs: DataFrame, records: DataFrame, same_class: bool = False) -> DataFrame:
    """``group_key, label_key, record_id``: '' and 0 where a group has no label or no usable record.

    With ``same_class`` the class of the item is a determinant of label and box: the box must then come from an item of the class the label
    names, and a record of another class is not taken however recent it is. A group without a label takes any box.
    """
    named = ("priority", "class") if same_class else ("priority",)
    det = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(d).alias("key"), F.col(d).alias("value")) for d in named]), lambda e: e["value"].isNotNull())).alias("determinants")
    cols = ["group", "bundle", "trust", "candidate", det]
    candidates = label_candidates(members, items, specs).select(*cols).unionByName(box_candidates(members, records).select(*cols))
    # Level by level: no gain in a label makes up for a source less trusted, and none in boxes for a label.
    chosen = best_representative(candidates, ["priority", "label", "box"], {"priority": 0, "label": 1, "box": 2})
    wide = chosen.groupBy("group").agg(F.max(F.when(F.col("bundle") == "label", F.col("candidate"))).alias("label_key"), F.max(F.when(F.col("bundle") == "box", F.col("candidate"))).alias("record"))
    groups = members.select("group_key").distinct()
    return groups.join(wide, F.col("group_key") == F.col("group"), "left").select(
        "group_key", F.coalesce("label_key", F.lit("")).alias("label_key"), F.coalesce(F.col("record").cast("bigint"), F.lit(0).cast("bigint")).alias("record_id")
    )
