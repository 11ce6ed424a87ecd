"""The operators' inputs, read from the tables of a data folder: Spark functions, and the same as SQL for the comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlane.functions.idents import CLASSES, class_of_key, item_ident, source_of_ident  # noqa: F401
from siftlane.operators.quality import latest_record
from siftlane.session import Scratch
from siftlane.sources.tables import canonical_items, table
from siftlane.streaming.compactor import named_files


def class_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c, k) for k, c in enumerate(CLASSES)], "target string, class_id int")


def items(spark: SparkSession, d: str) -> DataFrame:
    """``ident, key, class_name, source``."""
    keys = canonical_items(table(spark, d, "items"))
    return keys.select("ident", "key", class_of_key(F.col("key")).alias("class_name"), source_of_ident(F.col("ident")).alias("source"))


def detections(spark: SparkSession, d: str) -> DataFrame:
    """Usable detections, replayed ones once: ``object, image_id, class_id, score, severity``."""
    rows = table(spark, d, "detections").where("score >= 0 AND score <= 1 AND object_id IS NOT NULL")
    return rows.select(item_ident(F.col("object_id")).alias("object"), "image_id", "class_id", "score", "severity").distinct()


def truth(spark: SparkSession, d: str) -> DataFrame:
    """``object, class_id`` of every detected object; NULL for what is no item."""
    objects = detections(spark, d).select("object").distinct()
    known = items(spark, d).join(F.broadcast(class_table(spark)), F.col("class_name") == F.col("target")).select(F.col("ident").alias("object"), "class_id")
    return objects.join(known, "object", "left")


def scored(spark: SparkSession, d: str) -> DataFrame:
    """Detections of known objects with ``correct``."""
    known = truth(spark, d).where("class_id IS NOT NULL").withColumnRenamed("class_id", "true_id")
    return detections(spark, d).join(known, "object").withColumn("correct", F.col("class_id") == F.col("true_id"))


def labels(spark: SparkSession, d: str) -> DataFrame:
    """``ident, image, source, label_text``: the latest whole label file under an item's own name; ``image`` is the key."""
    files = named_files(table(spark, d, "item_files")).where("kind = 'label' AND NOT leftover")
    latest = files.groupBy("own").agg(F.max_by("body", F.struct("modified_at", "file_id")).alias("body"))
    joined = latest.join(items(spark, d), F.col("own") == F.col("ident"))
    return joined.select("ident", F.col("key").alias("image"), "source", F.decode("body", "UTF-8").alias("label_text"))


def provenance(spark: SparkSession, d: str) -> DataFrame:
    """``ident, image, record_id, method, confidence``: the record that holds for each item; NaN confidences are none."""
    rows = table(spark, d, "box_records").select(item_ident(F.col("image")).alias("ident"), "record_id", "method", F.nanvl("confidence", F.lit(None).cast("double")).alias("confidence"), "boxed_at")
    held = latest_record(rows.where("ident IS NOT NULL"))
    return held.join(items(spark, d).select("ident", F.col("key").alias("image")), "ident").select("ident", "image", "record_id", "method", "confidence")


def pool_edges(spark: SparkSession, d: str) -> DataFrame:
    """``key_a, key_b``: the near pairs (3 to 8 apart) between items, by canonical keys."""
    keys = Scratch(spark, "keys").keep(items(spark, d).select("ident", "key"), "keys")
    pairs = table(spark, d, "near_edges").where("distance BETWEEN 3 AND 8").select(item_ident(F.col("key_a")).alias("ia"), item_ident(F.col("key_b")).alias("ib")).where("ia <> ib")
    a, b = keys.select(F.col("ident").alias("ia"), F.col("key").alias("key_a")), keys.select(F.col("ident").alias("ib"), F.col("key").alias("key_b"))
    return pairs.join(a, "ia").join(b, "ib").select("key_a", "key_b").distinct()


def ident_sql(column: str) -> str:
    folders = "plastic|paper|cardboard|metal|glass|organic|wilderness"
    pattern = rf"(?:^|[/\\])\s*(?:(?:{folders})__)?([^/\\]*?)\s*(?:\.(?:jpg|jpeg|png|bmp|webp|txt))?\s*$"
    return rf"regexp_replace(regexp_extract(lower({column}), '{pattern}', 1), '\s+', '', 'g')"


CLASSES_SQL = "cls AS (SELECT * FROM (VALUES ('plastic', 0), ('paper', 1), ('cardboard', 2), ('metal', 3), ('glass', 4), ('organic', 5)) t(target, class_id))"
ITEMS_SQL = f"""{CLASSES_SQL},
it AS (SELECT id, k, split_part(k, '/', 1) AS class_name, split_part(id, '__', 1) AS source FROM (SELECT {ident_sql('key')} AS id, min(key) AS k FROM items GROUP BY 1))"""
DETS_SQL = f"""{ITEMS_SQL},
dets AS (SELECT DISTINCT {ident_sql('object_id')} AS object, image_id, class_id, score, severity FROM detections WHERE object_id IS NOT NULL AND NOT isnan(score) AND score BETWEEN 0 AND 1),
truth AS (SELECT object, class_id FROM (SELECT DISTINCT object FROM dets) LEFT JOIN (SELECT id, class_id FROM it JOIN cls ON class_name = target) ON id = object),
scored AS (SELECT d.*, d.class_id = t.class_id AS correct FROM dets d JOIN truth t USING (object) WHERE t.class_id IS NOT NULL),
top AS (SELECT object, image_id, severity, class_id, score FROM dets QUALIFY row_number() OVER (PARTITION BY object, image_id, severity ORDER BY score DESC, class_id) = 1)"""
FILES_SQL = rf"""{ITEMS_SQL},
f0 AS (SELECT file_id, modified_at, body, rtrim(url_decode(path)) AS t FROM item_files),
f1 AS (SELECT *, regexp_replace(t, '(?i)(\.(part|partial|bak|tmp|old|orig|crdownload))+$', '') AS p FROM f0),
f2 AS (SELECT *, lower(regexp_extract(p, '\.([A-Za-z0-9]+)$', 1)) AS suffix, {ident_sql('p')} AS own FROM f1)"""
LABELS_SQL = f"""{FILES_SQL},
labels AS (SELECT id, k AS image, source, decode(body) AS label_text FROM (SELECT * FROM f2 WHERE suffix = 'txt' AND t = p QUALIFY row_number() OVER (PARTITION BY own ORDER BY modified_at DESC, file_id DESC) = 1) JOIN it ON id = own),
lines AS (SELECT id, image, source, unnest(range(len(l))) AS pos, unnest(l) AS line FROM (SELECT *, list_filter(string_split(replace(replace(label_text, chr(65279), ''), chr(13), ''), chr(10)), lambda x: trim(x) <> '') AS l FROM labels)),
tok AS (SELECT *, regexp_split_to_array(trim(line), '\\s+') AS p, try_cast(regexp_split_to_array(trim(line), '\\s+')[1] AS INT) AS class_id FROM lines),
allbox AS (SELECT image, pos, class_id, try_cast(p[2] AS DOUBLE) AS cx, try_cast(p[3] AS DOUBLE) AS cy, try_cast(p[4] AS DOUBLE) AS w, try_cast(p[5] AS DOUBLE) AS h,
  coalesce(len(p) = 5 AND class_id >= 0 AND try_cast(p[2] AS DOUBLE) BETWEEN 0 AND 1 AND try_cast(p[3] AS DOUBLE) BETWEEN 0 AND 1 AND try_cast(p[4] AS DOUBLE) BETWEEN 0 AND 1 AND try_cast(p[5] AS DOUBLE) BETWEEN 0 AND 1, false) AS ok FROM tok),
box AS (SELECT * FROM allbox WHERE ok),
rec AS (SELECT id, k AS image, record_id, method, confidence FROM (SELECT {ident_sql('image')} AS i, record_id, method, CASE WHEN isnan(confidence) THEN NULL ELSE confidence END AS confidence, boxed_at FROM box_records) JOIN it ON id = i
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY boxed_at DESC NULLS LAST, confidence DESC NULLS LAST, record_id) = 1)"""
EDGES_SQL = f"""{ITEMS_SQL},
e AS (SELECT DISTINCT a.k AS key_a, b.k AS key_b FROM near_edges JOIN it a ON a.id = {ident_sql('key_a')} JOIN it b ON b.id = {ident_sql('key_b')} WHERE distance BETWEEN 3 AND 8 AND a.id <> b.id)"""


def reach_sql(edges: str) -> str:
    """Common table expressions ``comp(key, group_id)`` from an edge table; the query must start WITH RECURSIVE."""
    return f"""u AS (SELECT key_a AS a, key_b AS b FROM {edges} UNION SELECT key_b, key_a FROM {edges}),
reach(v, w) AS (SELECT a, a FROM u UNION SELECT r.v, u.b FROM reach r JOIN u ON u.a = r.w),
comp AS (SELECT v AS key, min(w) AS group_id FROM reach GROUP BY v)"""
