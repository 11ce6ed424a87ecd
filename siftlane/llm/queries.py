"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlane.functions.idents import class_of_key, item_ident, plain_name
from siftlane.llm import keeping_together, leakage, linking, mixing, mojibake, quota_sampling, survivors, top_items
from siftlane.session import Scratch
from siftlane.sources.tables import canonical_items, table


def _current(spark: SparkSession, d: str) -> DataFrame:
    return keeping_together.current_assignments(table(spark, d, "split_results"), canonical_items(table(spark, d, "items")))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return keeping_together.broken_ties(spark, _current(spark, d))


def p2_splits(spark: SparkSession, d: str) -> DataFrame:
    return keeping_together.assign_splits(spark, _current(spark, d)).select("run_id", "key", "split", "component")


def p2_shares(spark: SparkSession, d: str) -> DataFrame:
    placed = keeping_together.assign_splits(spark, _current(spark, d))
    counts = placed.groupBy("run_id", "split").agg(F.count("*").alias("items"), F.countDistinct("component").alias("components"), F.max("weight").alias("largest_component"))
    totals = placed.groupBy("run_id").agg(F.count("*").alias("all_items"))
    return counts.join(totals, "run_id").withColumn("share", F.round(F.col("items") / F.col("all_items"), 6))


def p2_document_splits(spark: SparkSession, d: str) -> DataFrame:
    """Documents tied by three columns: what they are about, an equal text, and what one source wrote at one time."""
    docs = table(spark, d, "documents")
    rows = docs.select(
        F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("doc"), item_ident(F.col("subject_key")).alias("subject"), F.md5("text").alias("words"),
        F.when(F.col("written_at").isNotNull(), F.concat_ws("@", plain_name(F.col("source")), F.unix_micros(F.col("written_at").cast("timestamp")).cast("string"))).alias("moment"),
    )
    return keeping_together.keep_together(spark, rows, ["subject", "words", "moment"], "doc", {"train": 0.8, "val": 0.1, "test": 0.1})


def _top_detections(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "detections").where("score >= 0 AND score <= 1 AND object_id IS NOT NULL")
    named = rows.select(item_ident(F.col("object_id")).alias("object"), "image_id", "class_id", "score", "severity", "det_id")
    return top_items.top_n(spark, named, "object", "score", ["class_id", "image_id", "severity"], "det_id", n=3)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _top_detections(spark, d).select("det_id")


def p3_top(spark: SparkSession, d: str) -> DataFrame:
    return _top_detections(spark, d)


def _members(spark: SparkSession, d: str) -> DataFrame:
    members = survivors.duplicate_members(table(spark, d, "dropped_dups"), canonical_items(table(spark, d, "items")))
    return Scratch(spark, "members").keep(members, "members")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return survivors.representatives(_members(spark, d), table(spark, d, "items"), table(spark, d, "source_specs"), table(spark, d, "box_records"))


def p4_same_class(spark: SparkSession, d: str) -> DataFrame:
    return survivors.representatives(_members(spark, d), table(spark, d, "items"), table(spark, d, "source_specs"), table(spark, d, "box_records"), same_class=True)


def _plans(spark: SparkSession, d: str) -> DataFrame:
    weights = quota_sampling.class_weights(table(spark, d, "remap_manifests"))
    return Scratch(spark, "quota").keep(quota_sampling.quotas(table(spark, d, "sample_plans"), weights), "quota")


def _sample(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The drawn sample, the report that goes with it, and the quotas."""
    pool = _current(spark, d).where("split = 'train'").select("run_id", "key", class_of_key(F.col("key")).alias("class_name"))
    wanted = _plans(spark, d)
    return *quota_sampling.draw(pool, wanted), wanted


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    sample, _, wanted = _sample(spark, d)
    drawn = sample.groupBy("plan_id", "class_name").agg(F.count("*").alias("drawn"))
    short = wanted.join(drawn, ["plan_id", "class_name"], "left").where(F.coalesce("drawn", F.lit(0)) < F.col("quota"))
    return short.select("plan_id", "class_name")


def p5_sample(spark: SparkSession, d: str) -> DataFrame:
    return _sample(spark, d)[0]


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    return _sample(spark, d)[1].select("plan_id", "class_name", "quota", "available", "taken", "exhausted")


def _groups(spark: SparkSession, d: str) -> DataFrame:
    items = Scratch(spark, "keys").keep(canonical_items(table(spark, d, "items")), "items")
    pairs = table(spark, d, "near_edges").where("distance BETWEEN 3 AND 8").select(item_ident(F.col("key_a")).alias("ia"), item_ident(F.col("key_b")).alias("ib")).where("ia <> ib").distinct()
    a = items.select(F.col("ident").alias("ia"), F.col("key").alias("a"))
    b = items.select(F.col("ident").alias("ib"), F.col("key").alias("b"))
    return linking.grid_components(spark, pairs.join(a, "ia").join(b, "ib").select("a", "b"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _groups(spark, d).select(F.col("v").alias("key"), F.col("root").alias("group_id"))


def p6_group_sizes(spark: SparkSession, d: str) -> DataFrame:
    return _groups(spark, d).groupBy(F.col("root").alias("group_id")).agg(F.count("*").alias("items"))


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leakage.find_leaks(spark, table(spark, d, "documents"), table(spark, d, "eval_passages"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).select("doc_id", "passage_id")


def p7_leaked_passages(spark: SparkSession, d: str) -> DataFrame:
    leaks = _leaks(spark, d).groupBy("passage_id").agg(F.count("*").alias("documents"), F.max("share").alias("largest_share"))
    return table(spark, d, "eval_passages").select("passage_id", "lang", "tier").join(leaks, "passage_id")


def _mix(spark: SparkSession, d: str) -> mixing.Mix:
    return mixing.mix_sources(spark, table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d).shares.where("short AND source IS NOT NULL").select("mix_id", "source")


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d).shares


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d).copies


def _garbled(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.find_garbled(spark, table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return _garbled(spark, d).select("doc_id")


def p9_restored(spark: SparkSession, d: str) -> DataFrame:
    return _garbled(spark, d)


#: German texts of which the letters and signs tell that they aren't garbled.
_CLEAN = "^[\\x01-\\x7eäöüßÄÖÜ„“–…°×’‚‘±]*[äöüß][\\x01-\\x7eäöüßÄÖÜ„“–…°×’‚‘±]*$"


def p9_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Clean German documents, garbled as UTF-8 read as cp1252 and added to all documents under negative ids: what is restored of them."""
    docs = table(spark, d, "documents").select("doc_id", "text")

    @F.pandas_udf("string")
    def garble(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t.encode("utf-8").decode("cp1252"))

    planted = docs.where(F.col("text").rlike(_CLEAN)).select((-F.col("doc_id") - 1).alias("doc_id"), garble("text").alias("text"))
    found = mojibake.find_garbled(spark, docs.unionByName(planted))
    return found.where("doc_id < 0").select((-F.col("doc_id") - 1).alias("doc_id"), F.col("restored").alias("text"))


QUERIES = {f.__name__: f for f in (p2_found, p2_splits, p2_shares, p2_document_splits, p3_found, p3_top, p4_found, p4_same_class, p5_found, p5_sample, p5_report, p6_found, p6_group_sizes, p7_found, p7_leaked_passages, p8_found, p8_shares, p8_mix, p9_found, p9_restored, p9_round_trip)}

_IDENT = r"regexp_replace(regexp_extract(lower({0}), '(?:^|[/\\])\s*(?:(?:plastic|paper|cardboard|metal|glass|organic|wilderness)__)?([^/\\]*?)\s*(?:\.(?:jpg|jpeg|png|bmp|webp|txt))?\s*$', 1), '\s+', '', 'g')"


def ident_sql(column: str) -> str:
    return _IDENT.replace("{0}", column)


_ITEMS = f"it AS (SELECT {ident_sql('key')} AS id, min(key) AS k FROM items GROUP BY 1)"
_CURRENT = f"""{_ITEMS}, cur AS (
  SELECT run_id, id, k, split_part(id, '__', 1) AS src, s.sp, s.g, s.lo FROM (
    SELECT run_id, {ident_sql('key')} AS id,
      arg_max(struct_pack(sp := regexp_replace(trim(lower(split)), '[\\s_\\-]+', '_', 'g'), g := nullif({ident_sql('group_id')}, ''), lo := leave_out_source), assigned_at) AS s
    FROM split_results GROUP BY 1, 2) JOIN it USING (id))"""

#: What is tied in a run: the left-out source with the groups that touch it is one component, every other group is one.
_SPLITS = f"""{_CURRENT}, touched AS (SELECT DISTINCT run_id, g FROM cur WHERE src = lo AND g IS NOT NULL),
hub AS (SELECT cur.*, CASE WHEN src = lo OR t.g IS NOT NULL THEN '=held' ELSE coalesce('g|' || cur.g, 'i|' || id) END AS h FROM cur LEFT JOIN touched t ON t.run_id = cur.run_id AND t.g = cur.g),
comp AS (SELECT run_id, h, min(k) AS component, count(*) AS weight, h = '=held' AS held, bool_or(lo IS NOT NULL) AS leaves FROM hub GROUP BY 1, 2),
mid AS (SELECT *, (coalesce(sum(weight) OVER (PARTITION BY run_id, held, leaves ORDER BY md5('42:' || component), component ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + weight / 2.0)::DOUBLE
  / sum(weight) OVER (PARTITION BY run_id, held, leaves) AS middle FROM comp),
cut AS (SELECT run_id, h, component, weight, CASE WHEN held THEN 'test' WHEN leaves THEN CASE WHEN middle < 0.85::DOUBLE - 1e-12 THEN 'train' ELSE 'val' END
  WHEN middle < 0.7225::DOUBLE - 1e-12 THEN 'train' WHEN middle < 0.85::DOUBLE - 1e-12 THEN 'val' ELSE 'test' END AS split FROM mid),
placed AS (SELECT hub.run_id, k AS key, src AS source, component, weight, split FROM hub JOIN cut USING (run_id, h))"""
_DOCUMENT_TIES = f"""d AS (SELECT lpad(doc_id::VARCHAR, 12, '0') AS doc, list_filter([ '0|' || nullif({ident_sql('subject_key')}, ''), '1|' || md5(text),
    '2|' || nullif(regexp_replace(trim(lower(source)), '[\\s_\\-]+', '-', 'g'), '') || '@' || epoch_us(written_at) ], lambda x: x IS NOT NULL) AS hubs FROM documents),
e AS (SELECT DISTINCT list_min(hubs) AS a, unnest(hubs) AS b FROM d), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach(v, w) AS (SELECT a, a FROM u UNION SELECT r.v, u.b FROM reach r JOIN u ON u.a = r.w),
root AS (SELECT v, min(w) AS r FROM reach GROUP BY v), tied AS (SELECT doc, coalesce(r, doc) AS r FROM d LEFT JOIN root ON v = list_min(hubs)),
comp AS (SELECT r, min(doc) AS component, count(*) AS weight FROM tied GROUP BY 1),
mid AS (SELECT *, (coalesce(sum(weight) OVER (ORDER BY md5('42:' || component), component ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + weight / 2.0)::DOUBLE / sum(weight) OVER () AS middle FROM comp)"""
_QUOTAS = f"""{_CURRENT}, have AS (SELECT run_id, split_part(k, '/', 1) AS c, count(*) AS n FROM cur WHERE sp = 'train' GROUP BY 1, 2),
w AS (SELECT manifest_id, c, sum(n) AS n FROM (SELECT manifest_id, lower(trim(e.key)) AS c, e.value AS n FROM (SELECT manifest_id, unnest(map_entries(any_value(class_counts))) AS e FROM remap_manifests GROUP BY manifest_id))
  WHERE c IN ('plastic', 'paper', 'cardboard', 'metal', 'glass', 'organic') GROUP BY 1, 2),
t AS (SELECT manifest_id, sum(n) AS total FROM w GROUP BY 1),
q AS (SELECT plan_id, p.run_id, w.c, greatest(coalesce(min_rows, 0), (sample_size * w.n + total - 1) // total)::BIGINT AS quota, coalesce(h.n, 0)::BIGINT AS available
  FROM sample_plans p JOIN w USING (manifest_id) JOIN t USING (manifest_id) LEFT JOIN have h ON h.run_id = p.run_id AND h.c = w.c WHERE w.n > 0)"""
_LINKED = f"""{_ITEMS}, e AS (SELECT DISTINCT a.k AS a, b.k AS b FROM near_edges JOIN it a ON a.id = {ident_sql('key_a')} JOIN it b ON b.id = {ident_sql('key_b')}
  WHERE distance BETWEEN 3 AND 8 AND a.id <> b.id),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach(v, w) AS (SELECT a, a FROM u UNION SELECT r.v, u.b FROM reach r JOIN u ON u.a = r.w)"""

_SURVIVORS = f"""{_ITEMS}, p AS (SELECT DISTINCT {ident_sql('duplicate_of')} AS g, {ident_sql('key')} AS m FROM dropped_dups),
mem AS (SELECT g, m FROM p UNION SELECT g, g FROM p),
m2 AS (SELECT gi.k AS gk, mi.k AS mk, mi.id AS mid FROM mem JOIN it gi ON gi.id = mem.g JOIN it mi ON mi.id = mem.m),
lab AS (SELECT DISTINCT {ident_sql('key')} AS id FROM items WHERE label IS NOT NULL AND trim(lower(label)) NOT IN ('', '-', 'nan', 'none', 'n/a')),
l AS (SELECT gk, mk FROM m2 JOIN lab ON lab.id = mid LEFT JOIN source_specs s ON s.source = split_part(mid, '__', 1)
  QUALIFY row_number() OVER (PARTITION BY gk ORDER BY priority, mk) = 1),
r AS (SELECT gk, mk, record_id, boxed_at, confidence FROM m2 JOIN (SELECT DISTINCT {ident_sql('image')} AS id, record_id, confidence, boxed_at FROM box_records
  WHERE confidence > 0 AND confidence <= 1 AND NOT isnan(confidence)) b ON b.id = mid)"""
_LATEST = "QUALIFY row_number() OVER (PARTITION BY gk ORDER BY boxed_at DESC, confidence DESC, record_id) = 1"

SQL = {
    "p9_round_trip": f"SELECT doc_id, text FROM documents WHERE regexp_matches(text, '{_CLEAN}')",
    "p2_found": f"""WITH {_CURRENT}, torn AS (SELECT run_id, g FROM cur WHERE g IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT sp) > 1)
SELECT run_id, k AS key FROM cur WHERE (run_id, g) IN (SELECT run_id, g FROM torn) OR (src = lo AND sp <> 'test') OR (sp = 'test' AND src IS DISTINCT FROM lo)""",
    "p2_splits": f"WITH {_SPLITS} SELECT run_id, key, split, component FROM placed",
    "p2_shares": f"""WITH {_SPLITS}, c AS (SELECT run_id, split, count(*) AS items, count(DISTINCT component) AS components, max(weight) AS largest_component FROM placed GROUP BY 1, 2)
SELECT c.*, all_items, round(items / all_items, 6) AS share FROM c JOIN (SELECT run_id, count(*) AS all_items FROM placed GROUP BY 1) USING (run_id)""",
    "p2_document_splits": f"""WITH RECURSIVE {_DOCUMENT_TIES} SELECT doc, component, CASE WHEN middle < 0.8::DOUBLE - 1e-12 THEN 'train' WHEN middle < 0.9::DOUBLE - 1e-12 THEN 'val' ELSE 'test' END AS split FROM tied JOIN mid USING (r)""",
    # No case is near its limit, so that any size of a text that grows with it gives the same rows.
    "p8_found": """WITH s AS (SELECT regexp_replace(trim(lower(source)), '[\\s_\\-]+', '-', 'g') AS source, sum(length(text)) AS n FROM documents GROUP BY 1),
a AS (SELECT sum(length(text)) AS n FROM documents)
SELECT mix_id, t.source FROM mix_targets t CROSS JOIN a LEFT JOIN s ON s.source = t.source WHERE target_weight * size_factor * a.n > max_repeat * coalesce(s.n, 0)""",
    "p3_found": f"""WITH d AS (SELECT {ident_sql('object_id')} AS o, image_id, class_id, score, severity, min(det_id) AS det_id FROM detections
  WHERE object_id IS NOT NULL AND NOT isnan(score) AND score BETWEEN 0 AND 1 GROUP BY ALL)
SELECT det_id FROM d QUALIFY row_number() OVER (PARTITION BY o ORDER BY score DESC, class_id, image_id, severity) <= 3""",
    "p3_top": f"""WITH d AS (SELECT {ident_sql('object_id')} AS object, image_id, class_id, score, severity, min(det_id) AS det_id FROM detections
  WHERE object_id IS NOT NULL AND NOT isnan(score) AND score BETWEEN 0 AND 1 GROUP BY ALL)
SELECT * FROM (SELECT *, (row_number() OVER (PARTITION BY object ORDER BY score DESC, class_id, image_id, severity))::INT AS rank FROM d) WHERE rank <= 3""",
    "p4_found": f"""WITH {_SURVIVORS} SELECT g.gk AS group_key, coalesce(l.mk, '') AS label_key, coalesce(r.record_id, 0) AS record_id FROM (SELECT DISTINCT gk FROM m2) g LEFT JOIN l USING (gk) LEFT JOIN (
  SELECT gk, record_id FROM r {_LATEST}) r USING (gk)""",
    "p4_same_class": f"""WITH {_SURVIVORS} SELECT g.gk AS group_key, coalesce(l.mk, '') AS label_key, coalesce(r.record_id, 0) AS record_id FROM (SELECT DISTINCT gk FROM m2) g LEFT JOIN l USING (gk) LEFT JOIN (
  SELECT r.gk, record_id FROM r LEFT JOIN l ON l.gk = r.gk WHERE l.mk IS NULL OR split_part(l.mk, '/', 1) = split_part(r.mk, '/', 1) {_LATEST.replace('gk', 'r.gk')}) r USING (gk)""",
    "p5_found": f"""WITH {_QUOTAS} SELECT plan_id, c AS class_name FROM q WHERE available < quota""",
    "p5_report": f"""WITH {_QUOTAS} SELECT plan_id, c AS class_name, quota, available, least(quota, available) AS taken, available < quota AS exhausted FROM q""",
    "p5_sample": f"""WITH {_QUOTAS}, pool AS (SELECT run_id, split_part(k, '/', 1) AS c, k, row_number() OVER (PARTITION BY run_id, split_part(k, '/', 1) ORDER BY md5('42:' || run_id || ':' || split_part(k, '/', 1) || ':' || k), k) AS place FROM cur WHERE sp = 'train')
SELECT plan_id, c AS class_name, k AS key FROM q JOIN pool USING (run_id, c) WHERE place <= quota""",
    "p6_group_sizes": f"""WITH RECURSIVE {_LINKED}, g AS (SELECT v, min(w) AS group_id FROM reach GROUP BY v) SELECT group_id, count(*) AS items FROM g GROUP BY 1""",
    "p6_found": f"""WITH RECURSIVE {_LINKED} SELECT v AS key, min(w) AS group_id FROM reach GROUP BY v""",
}
