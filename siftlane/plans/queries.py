"""The registered queries of the core, and their SQL. Names begin with the operator they run."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlane.functions import boxes as bx
from siftlane.functions.hashing import similarity_hash
from siftlane.functions.idents import plain_name
from siftlane.operators import autobox, balance, calibrate, consensus, dedup, evaluate, graph, qa, quality, remap, reports, split, sweep
from siftlane.plans import views
from siftlane.plans.views import DETS_SQL, EDGES_SQL, FILES_SQL, ITEMS_SQL, LABELS_SQL, reach_sql
from siftlane.session import Scratch, ship_package
from siftlane.sources.tables import canonical_items, table
from siftlane.streaming import compactor

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, with its SQL if there is one."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


# Parameters of the queries on detections.
TAU, VOTES, WATER = 0.5, 3, 0.6
TAUS, VOTE_GRID, WATERS = (0.25, 0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60), (2, 3, 4, 5), (0.5, 0.6, 0.7)
LEAVE_OUT, WILD, CLEAN, CLEAN_FRACTION, VAL = "quaybelt", ["milltray"], ["lumenbin", "curbnest"], 0.2, 0.15
CAP, FLOOR = 300, 250

# ---------------------------------------------------------------- compaction


def _unmarked(times: int) -> str:
    """The ident of a file's name without its last one or two copy marks."""
    name = "p"
    for _ in range(times):
        name = rf"regexp_replace({name}, '(?i)(\s*\(\d+\)|\s*-\s*copy)(\.[a-z]+)$', '\2')"
    return views.ident_sql(name)


def _log(spark: SparkSession, d: str) -> DataFrame:
    return compactor.stored_record_log(spark, f"{d}/item_files.parquet", canonical_items(table(spark, d, "items")))


_STORED = rf"""{FILES_SQL}, f3 AS (SELECT *, CASE WHEN suffix = 'txt' THEN 'label' ELSE 'image' END AS kind, {_unmarked(1)} AS o1, {_unmarked(2)} AS o2 FROM f2 WHERE suffix IN ('txt', 'jpg', 'jpeg', 'png', 'bmp', 'webp')),
r AS (SELECT file_id, kind, coalesce(a.k, b.k, c.k) AS k, t <> p AS leftover, a.k IS NULL AS renamed, modified_at, body
  FROM f3 LEFT JOIN it a ON a.id = own LEFT JOIN it b ON b.id = o1 LEFT JOIN it c ON c.id = o2 WHERE coalesce(a.k, b.k, c.k) IS NOT NULL)"""


@query(
    f"""WITH {_STORED} SELECT a.file_id AS file_a, b.file_id AS file_b FROM r a JOIN r b ON a.k = b.k AND a.kind = b.kind AND a.file_id < b.file_id"""
)
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return compactor.same_record_pairs(_log(spark, d))


@query(
    f"""WITH {_STORED}, best AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY k, kind ORDER BY leftover, renamed, modified_at DESC, octet_length(body) DESC, file_id) = 1), n AS (SELECT k, count(*) AS copies FROM r GROUP BY 1)
SELECT n.k AS key, i.file_id AS image_file, octet_length(i.body)::INT AS image_bytes, md5(i.body) AS image_md5, l.file_id AS label_file, octet_length(l.body)::INT AS label_bytes, md5(l.body) AS label_md5, copies
FROM n LEFT JOIN best i ON i.k = n.k AND i.kind = 'image' LEFT JOIN best l ON l.k = n.k AND l.kind = 'label'"""
)
def p1_compacted(spark: SparkSession, d: str) -> DataFrame:
    """The sealed records, with digests in place of the contents."""
    sealed = compactor.seal(_log(spark, d))
    about = lambda c: [F.col(f"{c}_file"), F.length(c).alias(f"{c}_bytes"), F.md5(c).alias(f"{c}_md5")]
    return sealed.select("key", *about("image"), *about("label"), "copies")


@query(f"WITH {_STORED} SELECT DISTINCT k AS key, kind, min(file_id) OVER (PARTITION BY k, kind) AS representative, file_id FROM r")
def p1_copies(spark: SparkSession, d: str) -> DataFrame:
    """Every file that holds a record, with the first file of that record."""
    return compactor.record_copies(_log(spark, d))


# ---------------------------------------------------------------- decisions


def _votes(spark: SparkSession, d: str) -> DataFrame:
    return consensus.top_frames(views.detections(spark, d)).where("severity >= 1")


def _one_tau(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(TAU, k, TAU) for k in range(6)], "cell double, class_id int, tau double")


_DECIDE = f"""v AS (SELECT object, class_id, count(*) FILTER (score >= {TAU}) AS q, max(score) AS hi FROM top WHERE severity >= 1 GROUP BY 1, 2),
dec AS (SELECT object, CASE WHEN q >= {VOTES} AND 2 * q > tot AND hi >= {WATER} THEN class_id END AS decision FROM (SELECT *, sum(q) OVER (PARTITION BY object) AS tot FROM v)
  QUALIFY row_number() OVER (PARTITION BY object ORDER BY q DESC, class_id) = 1)"""


@query(f"WITH {DETS_SQL} SELECT object, image_id, severity, class_id, score FROM top")
def wn1_top_frame(spark: SparkSession, d: str) -> DataFrame:
    return consensus.top_frames(views.detections(spark, d))


@query(f"WITH {DETS_SQL} SELECT image_id, severity, max(score) AS score FROM dets GROUP BY 1, 2")
def wn2_top_score(spark: SparkSession, d: str) -> DataFrame:
    return consensus.top_scores(views.detections(spark, d))


@query(f"WITH {DETS_SQL}, {_DECIDE} SELECT object, decision FROM dec")
def th1_consensus(spark: SparkSession, d: str) -> DataFrame:
    return consensus.decide(consensus.tally(_votes(spark, d), _one_tau(spark)), VOTES, WATER).select("object", "decision")


@query(f"WITH {DETS_SQL}, {_DECIDE} SELECT id AS object, cls.class_id, decision FROM it JOIN cls ON class_name = target LEFT JOIN dec ON dec.object = id")
def jn9_zero_votes(spark: SparkSession, d: str) -> DataFrame:
    known = views.items(spark, d).join(F.broadcast(views.class_table(spark)), F.col("class_name") == F.col("target")).select(F.col("ident").alias("object"), "class_id")
    return consensus.with_silent(known, th1_consensus(spark, d))


@query(
    f"""WITH {DETS_SQL}, {_DECIDE}, j AS (SELECT t.class_id AS truth, decision FROM truth t LEFT JOIN dec USING (object))
SELECT count(*)::BIGINT AS objects, round(count(*) FILTER (decision IS NOT NULL AND decision IS DISTINCT FROM truth) / count(*), 9) AS wrong_bin_rate,
  round(count(*) FILTER (truth IS NOT NULL AND decision IS NULL) / count(truth), 9) AS rest_rate FROM j"""
)
def th5_cell_metrics(spark: SparkSession, d: str) -> DataFrame:
    j = consensus.with_silent(views.truth(spark, d), th1_consensus(spark, d))
    wrong = F.col("decision").isNotNull() & ~F.col("decision").eqNullSafe(F.col("class_id"))
    return j.agg(
        F.count("*").alias("objects"),
        F.round(F.count_if(wrong) / F.count("*"), 9).alias("wrong_bin_rate"),
        F.round(F.count_if(F.col("class_id").isNotNull() & F.col("decision").isNull()) / F.count("class_id"), 9).alias("rest_rate"),
    )


def _global_taus(cells: DataFrame) -> DataFrame:
    classes = cells.sparkSession.range(6).select(F.col("id").cast("int").alias("class_id"))
    return cells.select("tau_frame").distinct().crossJoin(classes).select("tau_frame", "class_id", F.col("tau_frame").alias("tau"))


def _swept(spark: SparkSession, d: str) -> DataFrame:
    cells = sweep.grid(spark, TAUS, VOTE_GRID, WATERS)
    return Scratch(spark, "sweep").keep(sweep.sweep(_votes(spark, d), views.truth(spark, d), cells, _global_taus(cells)), "sweep")


_list = lambda xs: "[" + ", ".join(map(str, xs)) + "]"
_SWEEP = f"""grid AS (SELECT (row_number() OVER (ORDER BY a, b, c) - 1)::INT AS cell_idx, ({_list(TAUS)})[a]::DOUBLE AS tau_frame, ({_list(VOTE_GRID)})[b]::INT AS min_votes, ({_list(WATERS)})[c]::DOUBLE AS high_water
  FROM range(1, 9) x(a), range(1, 5) y(b), range(1, 4) z(c)),
vt AS (SELECT t AS tau, object, class_id, count(*) FILTER (score >= t) AS q, max(score) AS hi FROM top, (SELECT unnest({_list(TAUS)})::DOUBLE AS t) WHERE severity >= 1 GROUP BY 1, 2, 3),
best AS (SELECT *, sum(q) OVER (PARTITION BY tau, object) AS tot FROM vt QUALIFY row_number() OVER (PARTITION BY tau, object ORDER BY q DESC, class_id) = 1),
fact AS (SELECT cell_idx, tau_frame, min_votes, high_water, t.class_id AS truth, CASE WHEN q >= min_votes AND 2 * q > tot AND hi >= high_water THEN b.class_id END AS dcn
  FROM grid CROSS JOIN truth t LEFT JOIN best b ON b.tau = tau_frame AND b.object = t.object),
swept AS (SELECT cell_idx, tau_frame, round(tau_frame, 9) AS tau_mean, min_votes, high_water, round(count(*) FILTER (dcn IS NOT NULL AND dcn IS DISTINCT FROM truth) / count(*), 9) AS wrong_bin_rate,
  round(count(*) FILTER (truth IS NOT NULL AND dcn IS NULL) / count(truth), 9) AS rest_rate FROM fact GROUP BY ALL)"""
_FRONT = "front AS (SELECT * FROM swept s WHERE NOT EXISTS (SELECT 1 FROM swept o WHERE o.wrong_bin_rate <= s.wrong_bin_rate AND o.rest_rate <= s.rest_rate AND (o.wrong_bin_rate < s.wrong_bin_rate OR o.rest_rate < s.rest_rate)))"


@query(f"WITH {DETS_SQL}, {_SWEEP} SELECT * FROM swept")
def th6_sweep(spark: SparkSession, d: str) -> DataFrame:
    return _swept(spark, d)


@query(f"WITH {DETS_SQL}, {_SWEEP}, {_FRONT} SELECT * FROM front")
def th7_pareto(spark: SparkSession, d: str) -> DataFrame:
    return sweep.front(_swept(spark, d))


@query(
    f"""WITH {DETS_SQL}, {_SWEEP}, {_FRONT}, ok AS (SELECT *, true AS feasible FROM front WHERE wrong_bin_rate <= {sweep.WRONG_MOST} ORDER BY rest_rate, wrong_bin_rate, cell_idx LIMIT 1),
fb AS (SELECT *, false AS feasible FROM swept ORDER BY wrong_bin_rate, rest_rate, cell_idx LIMIT 1)
SELECT * FROM ok UNION ALL SELECT * FROM fb WHERE NOT EXISTS (SELECT 1 FROM ok)"""
)
def th8_knee(spark: SparkSession, d: str) -> DataFrame:
    return sweep.choose(_swept(spark, d))


@query(
    f"""WITH {DETS_SQL}, {_SWEEP} SELECT * EXCLUDE (least) FROM (SELECT *, min(rest_rate) OVER (ORDER BY wrong_bin_rate, rest_rate, cell_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS least FROM swept)
WHERE least IS NULL OR rest_rate < least"""
)
def wn7_skyline(spark: SparkSession, d: str) -> DataFrame:
    return sweep.skyline(_swept(spark, d))


_CURVE = """cells AS (SELECT class_id, least(floor(score * 100 + 1e-9), 100)::INT AS idx, count(*) AS n, count(*) FILTER (correct) AS good FROM scored GROUP BY 1, 2),
axis AS (SELECT class_id, unnest(range(101))::INT AS idx FROM (SELECT DISTINCT class_id FROM scored)),
sums AS (SELECT class_id, idx, sum(coalesce(n, 0)) OVER w AS n, sum(coalesce(good, 0)) OVER w AS good, sum(coalesce(good, 0)) OVER (PARTITION BY class_id) AS all_good FROM axis LEFT JOIN cells USING (class_id, idx)
  WINDOW w AS (PARTITION BY class_id ORDER BY idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
curve AS (SELECT class_id, idx, idx / 100 AS confidence, CASE WHEN n > 0 THEN good / n ELSE 1.0 END::DOUBLE AS precision, CASE WHEN all_good > 0 THEN good / all_good ELSE 0.0 END::DOUBLE AS recall FROM sums)"""
HOLD = 0.85
_SUSTAIN = f"""mark AS (SELECT class_id, coalesce(max(idx) FILTER (precision < {HOLD}) + 1, min(idx)) AS idx FROM curve GROUP BY 1),
pts AS (SELECT class_id, confidence AS conf FROM mark LEFT JOIN curve USING (class_id, idx))"""
_ANCHORS = f"""anchors AS (SELECT class_id, anchor, (max(anchor) OVER () - min(anchor) OVER ()) > {sweep.SPAN} AS per_class
  FROM (SELECT class_id, least(greatest(coalesce(conf, {sweep.TAU_HIGH}), {sweep.TAU_LOW}), {sweep.TAU_HIGH})::DOUBLE AS anchor FROM pts))"""


def _curve(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.precision_curve(views.scored(spark, d))


@query(f"WITH {DETS_SQL}, {_CURVE} SELECT class_id, idx, round(confidence, 9) AS confidence, round(precision, 9) AS precision, round(recall, 9) AS recall FROM curve")
def m20_curves(spark: SparkSession, d: str) -> DataFrame:
    return _curve(spark, d).select("class_id", "idx", F.round("confidence", 9).alias("confidence"), F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"))


@query(f"WITH {DETS_SQL}, {_CURVE}, {_SUSTAIN} SELECT class_id, round(conf, 9) AS conf FROM pts")
def wn3_conf_at_precision(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.sustained_confidence(_curve(spark, d), HOLD).select("class_id", F.round("conf", 9).alias("conf"))


@query(
    f"""WITH {DETS_SQL}, {_CURVE}, seg AS (SELECT class_id, confidence AS c0, precision AS p0, lead(confidence) OVER w AS c1, lead(precision) OVER w AS p1 FROM curve WINDOW w AS (PARTITION BY class_id ORDER BY idx))
SELECT class_id, 0.655::DOUBLE AS conf, round(coalesce(p0 + (0.655 - c0) / (c1 - c0) * (p1 - p0), p0), 6) AS precision FROM seg WHERE 0.655 >= c0 AND (0.655 < c1 OR c1 IS NULL)"""
)
def ge13_interpolate(spark: SparkSession, d: str) -> DataFrame:
    curve = _curve(spark, d)
    at = curve.select("class_id").distinct().withColumn("conf", F.lit(0.655))
    return evaluate.interpolate(curve, at).withColumn("precision", F.round("precision", 6))


def _anchors(spark: SparkSession, d: str) -> DataFrame:
    return sweep.per_class_anchors(evaluate.sustained_confidence(_curve(spark, d), HOLD))


@query(f"WITH {DETS_SQL}, {_CURVE}, {_SUSTAIN}, {_ANCHORS} SELECT class_id, round(anchor, 9) AS anchor, per_class FROM anchors")
def th3_per_class_tau(spark: SparkSession, d: str) -> DataFrame:
    return _anchors(spark, d).withColumn("anchor", F.round("anchor", 9))


_CELL_TAUS = f"""taus AS (SELECT t AS tau_frame, class_id, CASE WHEN per_class THEN least(greatest(anchor + t - m, {sweep.TAU_LOW}), {sweep.TAU_HIGH}) ELSE t END::DOUBLE AS tau
  FROM (SELECT unnest({_list(TAUS)})::DOUBLE AS t), (SELECT *, avg(anchor) OVER () AS m FROM anchors))"""


@query(f"WITH {DETS_SQL}, {_CURVE}, {_SUSTAIN}, {_ANCHORS}, {_CELL_TAUS} SELECT tau_frame, class_id, round(tau, 6) AS tau FROM taus")
def th4_cell_taus(spark: SparkSession, d: str) -> DataFrame:
    return sweep.cell_taus(sweep.grid(spark, TAUS, [2], [0.5]), _anchors(spark, d)).withColumn("tau", F.round("tau", 6))


_TUNED = _SWEEP.replace("SELECT t AS tau, object, class_id, count(*) FILTER (score >= t) AS q, max(score) AS hi FROM top, (SELECT unnest(" + _list(TAUS) + ")::DOUBLE AS t) WHERE", "SELECT tau_frame AS tau, object, class_id, count(*) FILTER (score >= t.tau) AS q, max(score) AS hi FROM top JOIN taus t USING (class_id) WHERE").replace(
    "round(tau_frame, 9) AS tau_mean", "round((SELECT avg(tau) FROM taus x WHERE x.tau_frame = fact.tau_frame), 9) AS tau_mean"
)


@query(
    f"""WITH {DETS_SQL}, {_CURVE}, {_SUSTAIN}, {_ANCHORS}, {_CELL_TAUS}, {_TUNED}, {_FRONT},
pick AS (SELECT cell_idx FROM (SELECT cell_idx, 0 AS a, rest_rate AS b, wrong_bin_rate AS c FROM front WHERE wrong_bin_rate <= {sweep.WRONG_MOST} UNION ALL SELECT cell_idx, 1, wrong_bin_rate, rest_rate FROM swept) ORDER BY a, b, c, cell_idx LIMIT 1)
SELECT *, (cell_idx = (SELECT cell_idx FROM pick))::INT AS chosen FROM swept"""
)
def th10_tune(spark: SparkSession, d: str) -> DataFrame:
    """The whole tuning: anchors from the curves, per-class thresholds for each cell, the sweep, the choice."""
    cells = sweep.grid(spark, TAUS, VOTE_GRID, WATERS)
    taus = Scratch(spark, "taus").keep(sweep.cell_taus(cells, _anchors(spark, d)), "taus")
    swept = Scratch(spark, "tune").keep(sweep.sweep(_votes(spark, d), views.truth(spark, d), cells, taus), "swept")
    chosen = sweep.choose(swept).select("cell_idx", "feasible")
    return swept.join(F.broadcast(chosen), "cell_idx", "left").withColumn("chosen", F.col("feasible").isNotNull().cast("int")).drop("feasible")


_VAL_TRUTH = f"""cur AS (SELECT run_id, {views.ident_sql('key')} AS id, arg_max(struct_pack(sp := regexp_replace(trim(lower(split)), '[\\s_\\-]+', '_', 'g'), g := nullif({views.ident_sql('group_id')}, '')), assigned_at) AS s FROM split_results GROUP BY 1, 2)"""


@query(
    f"""WITH {ITEMS_SQL}, {_VAL_TRUTH} SELECT run_id || '|' || s.g AS object, min(class_id) AS class_id, min(class_id) <> max(class_id) AS mixed
FROM cur JOIN it USING (id) JOIN cls ON class_name = target WHERE s.sp = 'val' AND s.g IS NOT NULL GROUP BY 1"""
)
def th9_truth(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "split_results")
    from siftlane.functions.idents import item_ident, split_name

    now = F.struct("assigned_at", split_name(F.col("split")).alias("split"), item_ident(F.col("group_id")).alias("g"))
    current = rows.groupBy("run_id", item_ident(F.col("key")).alias("ident")).agg(F.max(now).alias("now")).where("now.split = 'val' AND now.g IS NOT NULL")
    known = views.items(spark, d).join(F.broadcast(views.class_table(spark)), F.col("class_name") == F.col("target")).select("ident", "class_id")
    return consensus.group_truth(current.join(known, "ident").select(F.concat_ws("|", "run_id", "now.g").alias("object"), "class_id"))


_NUMBER = "('0x' || substr(md5({0}), 1, 8))::BIGINT"


@query(
    f"""WITH {DETS_SQL}, p0 AS (SELECT *, (severity >= 1)::INT AS deg FROM top), p1 AS (SELECT * FROM p0 QUALIFY deg = max(deg) OVER (PARTITION BY object)),
pool AS (SELECT *, row_number() OVER (PARTITION BY object ORDER BY image_id, severity) - 1 AS k, count(*) OVER (PARTITION BY object) AS size FROM p1),
o AS (SELECT DISTINCT object, size, {_NUMBER.format("'42:draws:' || object")} % 11 + 5 AS m FROM pool), dr AS (SELECT object, size, unnest(range(1, m + 1))::INT AS draw FROM o)
SELECT object, draw, class_id, score FROM (SELECT *, {_NUMBER.format("'42:' || draw || ':' || object")} % size AS k FROM dr) JOIN pool USING (object, k)"""
)
def bl7_sightings(spark: SparkSession, d: str) -> DataFrame:
    return consensus.sightings(consensus.top_frames(views.detections(spark, d)))


# ---------------------------------------------------------------- calibration


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return views.scored(spark, d).select("score", F.col("correct").cast("double").alias("label"))


@query(
    f"""WITH {DETS_SQL}, b AS (SELECT least(floor(score * 15), 14) AS bin, count(*) AS n, avg(score) AS c, avg(correct::DOUBLE) AS a FROM scored GROUP BY 1)
SELECT sum(n)::BIGINT AS n, round(sum(n * abs(c - a)) / sum(n), 6) AS ece FROM b"""
)
def ag11_ece(spark: SparkSession, d: str) -> DataFrame:
    return calibrate.calibration_error(_pairs(spark, d)).withColumn("ece", F.round("ece", 6))


_TEMP = "1 / (1 + exp(-ln(least(greatest(score, 1e-6), 1 - 1e-6) / (1 - least(greatest(score, 1e-6), 1 - 1e-6))) / 1.5))"


@query(f"WITH {DETS_SQL}, p AS (SELECT correct::DOUBLE AS y, least(greatest({_TEMP}, 1e-6), 1 - 1e-6) AS p FROM scored) SELECT count(*)::BIGINT AS n, round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), 6) AS nll FROM p")
def ag12_nll(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).agg(F.count("*").alias("n"), F.round(F.avg(calibrate.nll(F.col("score"), F.col("label"), 1.5)), 6).alias("nll"))


@query(f"WITH {DETS_SQL} SELECT object, image_id, severity, class_id, score, round({_TEMP}, 6) AS calibrated FROM dets")
def ca1_temperature(spark: SparkSession, d: str) -> DataFrame:
    return views.detections(spark, d).withColumn("calibrated", F.round(calibrate.with_temperature(F.col("score"), 1.5), 6))


#: Step of the logarithm to which a fitted temperature is reported.
LOG_STEP = 0.01


@query(
    f"""WITH {DETS_SQL}, p AS (SELECT score, correct::DOUBLE AS y, count(*) AS n FROM scored GROUP BY 1, 2), l AS (SELECT n, y, ln(least(greatest(score, 1e-6), 1 - 1e-6) / (1 - least(greatest(score, 1e-6), 1 - 1e-6))) AS z FROM p),
g AS (SELECT k, sum(n * -(y * ln(q) + (1 - y) * ln(1 - q))) AS loss FROM (SELECT k, n, y, least(greatest(1 / (1 + exp(-z / exp(k * {LOG_STEP}::DOUBLE))), 1e-6), 1 - 1e-6) AS q FROM l, range(-460, 461) r(k)) GROUP BY 1)
SELECT round(exp(arg_min(k, loss) * {LOG_STEP}::DOUBLE), 6) AS temperature FROM g"""
)
def ca2_fit_temperature(spark: SparkSession, d: str) -> DataFrame:
    """The fitted temperature, to the nearest step of the logarithm that has the least loss."""
    pairs = _pairs(spark, d)
    near = round(math.log(calibrate.fit_temperature(pairs)) / LOG_STEP)
    steps = range(near - 2, near + 3)
    losses = calibrate.total_nll(pairs.groupBy("score", "label").agg(F.count("*").alias("n")), [k * LOG_STEP for k in steps])
    best = min(zip(losses, steps, strict=True))[1]
    return spark.createDataFrame([(round(math.exp(best * LOG_STEP), 6),)], "temperature double")


@query(
    """SELECT count(*) FILTER (score IS NULL OR isnan(score)) AS no_score, count(*) FILTER (NOT isnan(score) AND (score < 0 OR score > 1)) AS out_of_range, count(*) FILTER (class_id NOT IN (0, 1)) AS not_binary FROM detections"""
)
def ca3_validate(spark: SparkSession, d: str) -> DataFrame:
    return calibrate.invalid_pairs(table(spark, d, "detections").select("score", F.col("class_id").cast("double").alias("label")))


@query(
    f"""WITH {DETS_SQL}, s AS (SELECT max(score) AS score FROM dets GROUP BY image_id, severity), c AS (SELECT least(floor(score * 40), 39)::INT AS bin, count(*) AS n FROM s GROUP BY 1)
SELECT bin, coalesce(n, 0) AS n, round(coalesce(n, 0) * 40 / sum(coalesce(n, 0)) OVER (), 6) AS density FROM (SELECT unnest(range(40))::INT AS bin) LEFT JOIN c USING (bin)"""
)
def ag16_hist(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.density(consensus.top_scores(views.detections(spark, d))).withColumn("density", F.round("density", 6))


# ---------------------------------------------------------------- boxes and quality


def _boxes(spark: SparkSession, d: str) -> DataFrame:
    return bx.boxes_table(views.labels(spark, d)).where("ok").drop("ok")


@query(f"WITH {LABELS_SQL} SELECT image, pos FROM allbox WHERE NOT ok UNION ALL SELECT image, max(pos) + 1 AS pos FROM allbox GROUP BY image")
def sc3_bad_lines(spark: SparkSession, d: str) -> DataFrame:
    """Bad lines of all label files, to each of which that has lines a bad one has been added."""
    labels = views.labels(spark, d)
    worse = labels.withColumn("label_text", F.concat(F.rtrim("label_text"), F.lit("\nx 0.5 0.5 0.1")))
    lines = labels.select("image", F.size(bx.label_lines(F.col("label_text"))).alias("n")).where("n > 0").select("image")
    return bx.boxes_table(worse.join(lines, "image", "left_semi")).where("NOT ok").select("image", F.col("pos").cast("bigint").alias("pos"))


@query(f"WITH {LABELS_SQL} SELECT l.image, round(CASE WHEN bool_and(ok) THEN max(w * h) END, 12) AS largest FROM labels l LEFT JOIN allbox b ON b.image = l.image GROUP BY 1")
def sc4_largest_box(spark: SparkSession, d: str) -> DataFrame:
    return views.labels(spark, d).select("image", F.round(quality.largest_box(F.col("label_text")), 12).alias("largest"))


@query(
    f"""WITH {LABELS_SQL} SELECT image, pos, round(w * h, 12) AS area, round(w / nullif(h, 0), 6) AS aspect, round(cx - w / 2, 9) AS x1, round(cy - h / 2, 9) AS y1, round(cx + w / 2, 9) AS x2, round(cy + h / 2, 9) AS y2,
  (cx - w / 2 <= 0.005)::INT + (cy - h / 2 <= 0.005)::INT + (cx + w / 2 >= 0.995)::INT + (cy + h / 2 >= 0.995)::INT AS edges FROM box"""
)
def ge1_geometry(spark: SparkSession, d: str) -> DataFrame:
    c = [F.col(x) for x in ("cx", "cy", "w", "h")]
    corners = [x.alias(n) for n, x in zip(("x1", "y1", "x2", "y2"), [F.round(v, 9) for v in bx.corners(*c)], strict=True)]
    return _boxes(spark, d).select("image", F.col("pos").cast("bigint").alias("pos"), F.round(bx.area(c[2], c[3]), 12).alias("area"), F.round(bx.aspect(c[2], c[3]), 6).alias("aspect"), *corners, bx.edges_touched(*c).alias("edges"))


_Z = """single AS (SELECT * FROM box QUALIFY count(*) OVER (PARTITION BY image) = 1),
st AS (SELECT class_id, count(*) AS n, avg(w * h) AS ma, stddev_pop(w * h) AS sa, count(w / nullif(h, 0)) AS np, avg(w / nullif(h, 0)) AS mp, stddev_pop(w / nullif(h, 0)) AS sp FROM single GROUP BY 1),
z AS (SELECT s.*, w * h AS area, CASE WHEN n >= 2 THEN (w * h - ma) / nullif(round(sa, 12), 0) END AS area_z, CASE WHEN np >= 2 THEN (w / nullif(h, 0) - mp) / nullif(round(sp, 12), 0) END AS aspect_z FROM single s JOIN st USING (class_id))"""


@query(f"WITH {LABELS_SQL}, {_Z} SELECT image, class_id, round(area_z, 5) AS area_z, round(aspect_z, 5) AS aspect_z FROM z")
def ag1_zscores(spark: SparkSession, d: str) -> DataFrame:
    return qa.zscores(_boxes(spark, d)).select("image", "class_id", F.round("area_z", 5).alias("area_z"), F.round("aspect_z", 5).alias("aspect_z"))


_FLAGS = f"""{_Z}, n AS (SELECT image, count(*) AS n_boxes FROM box GROUP BY 1),
flagged AS (SELECT r.image, coalesce(n_boxes, 0) AS n_boxes, z.class_id, confidence, list_filter([CASE WHEN coalesce(n_boxes, 0) <> 1 THEN 'box_count' END,
  CASE WHEN n_boxes = 1 AND (area < 0.05 OR area > 0.95) THEN 'area_extreme' END, CASE WHEN n_boxes = 1 AND abs(area_z) > 3 THEN 'area_zscore' END, CASE WHEN n_boxes = 1 AND abs(aspect_z) > 3 THEN 'aspect_zscore' END,
  CASE WHEN n_boxes = 1 AND (cx - w / 2 <= 0.005)::INT + (cy - h / 2 <= 0.005)::INT + (cx + w / 2 >= 0.995)::INT + (cy + h / 2 >= 0.995)::INT >= 3 THEN 'edge_contact' END,
  CASE WHEN confidence < 0.3 THEN 'low_confidence' END, CASE WHEN method = 'centerbox' THEN 'centerbox' END], lambda x: x IS NOT NULL) AS flags
  FROM rec r LEFT JOIN n ON n.image = r.image LEFT JOIN z ON z.image = r.image)"""


def _flagged(spark: SparkSession, d: str) -> DataFrame:
    return qa.qa_flags(views.provenance(spark, d), _boxes(spark, d))


@query(f"WITH {LABELS_SQL}, {_FLAGS} SELECT image, n_boxes, class_id, array_to_string(flags, '|') AS flags FROM flagged")
def pf9_qa_flags(spark: SparkSession, d: str) -> DataFrame:
    return _flagged(spark, d).withColumn("flags", F.array_join("flags", "|"))


@query(f"WITH {LABELS_SQL}, {_FLAGS} SELECT flag, count(*) AS images FROM (SELECT unnest(flags) AS flag FROM flagged) GROUP BY 1")
def ag2_flag_counts(spark: SparkSession, d: str) -> DataFrame:
    return qa.flag_counts(_flagged(spark, d))


@query(f"WITH {LABELS_SQL}, {_FLAGS} SELECT image, n_boxes, class_id, flag, array_to_string(flags, '|') AS all_flags FROM (SELECT *, unnest(flags) AS flag FROM flagged)")
def sk4_review_queue(spark: SparkSession, d: str) -> DataFrame:
    return qa.review_queue(_flagged(spark, d))


@query(f"WITH {LABELS_SQL} SELECT image FROM labels WHERE image NOT IN (SELECT image FROM rec)")
def pf10_stray(spark: SparkSession, d: str) -> DataFrame:
    return qa.stray_labels(views.labels(spark, d).select("image"), views.provenance(spark, d).select("image"))


_IOU = """ref AS (SELECT image, pos, cx + 0.02 * (pos % 3) AS cx, cy, w * 0.9 AS w, h FROM box),
pair AS (SELECT a.image, greatest(least(a.cx + a.w / 2, b.cx + b.w / 2) - greatest(a.cx - a.w / 2, b.cx - b.w / 2), 0) * greatest(least(a.cy + a.h / 2, b.cy + b.h / 2) - greatest(a.cy - a.h / 2, b.cy - b.h / 2), 0) AS i, a.w * a.h + b.w * b.h AS s FROM box a JOIN ref b USING (image)),
iou AS (SELECT image, coalesce(max(CASE WHEN s - i > 0 THEN i / (s - i) ELSE 0 END), 0) AS iou FROM pair GROUP BY 1)"""


def _overlaps(spark: SparkSession, d: str) -> DataFrame:
    ours = _boxes(spark, d)
    moved = ours.withColumn("cx", F.col("cx") + F.lit(0.02) * (F.col("pos") % 3)).withColumn("w", F.col("w") * 0.9)
    return qa.best_overlaps(ours, moved)


@query(f"WITH {LABELS_SQL}, {_IOU} SELECT image, round(iou, 6) AS iou FROM iou")
def ge4_iou(spark: SparkSession, d: str) -> DataFrame:
    return _overlaps(spark, d).withColumn("iou", F.round("iou", 6))


_STATS = "count(*) AS images, round(avg(iou), 6) AS mean, round(quantile_cont(iou, 0.25), 6) AS q1, round(quantile_cont(iou, 0.5), 6) AS median, round(quantile_cont(iou, 0.75), 6) AS q3, round(min(iou), 6) AS low, round(max(iou), 6) AS high, round(avg((iou >= 0.8)::DOUBLE), 6) AS frac_good"


@query(f"WITH {LABELS_SQL}, {_IOU} SELECT {_STATS} FROM (SELECT round(iou, 9) AS iou FROM iou)")
def ag4_iou_stats(spark: SparkSession, d: str) -> DataFrame:
    stats = qa.overlap_stats(_overlaps(spark, d).withColumn("iou", F.round("iou", 9)))
    return stats.select("images", *[F.round(c, 6).alias(c) for c in stats.columns if c != "images"])


@query(
    f"""WITH {LABELS_SQL}, {_FLAGS}, {_IOU}, m AS (SELECT (SELECT avg((len(flags) > 0)::INT) FROM flagged) AS review, (SELECT avg((iou < 0.5)::INT) FROM iou) AS loc, (SELECT quantile_cont(round(iou, 9), 0.5) FROM iou) AS med)
SELECT round(review, 6) AS review_fail, round(loc, 6) AS location_fail, round(med, 6) AS median_iou, CASE WHEN review <= 0.10 AND loc <= 0.20 AND med >= 0.80 THEN 'pass' ELSE 'fail' END AS verdict FROM m"""
)
def ag3_gate(spark: SparkSession, d: str) -> DataFrame:
    review = _flagged(spark, d).agg(F.avg((F.size("flags") > 0).cast("int")).alias("review_fail"))
    loc = _overlaps(spark, d).withColumn("iou", F.round("iou", 9)).agg(F.avg((F.col("iou") < 0.5).cast("int")).alias("location_fail"), F.expr("percentile(iou, 0.5)").alias("median_iou"))
    joined = review.crossJoin(loc)
    verdict = qa.gate(F.col("review_fail"), F.col("location_fail"), F.col("median_iou"))
    return joined.select(F.round("review_fail", 6).alias("review_fail"), F.round("location_fail", 6).alias("location_fail"), F.round("median_iou", 6).alias("median_iou"), verdict.alias("verdict"))


_REFUSE = """big AS (SELECT l.image, CASE WHEN bool_and(ok) THEN max(w * h) END AS largest FROM labels l LEFT JOIN allbox b ON b.image = l.image GROUP BY 1),
refused AS (SELECT it.k AS key, CASE WHEN method = 'centerbox' THEN 'method' WHEN method IS NOT NULL AND coalesce(confidence, 0) < 0.3 THEN 'low_confidence' WHEN largest > 0.92 THEN 'box_too_large' WHEN largest < 0.005 THEN 'box_too_small' END AS reason
  FROM it LEFT JOIN rec ON rec.image = it.k LEFT JOIN big ON big.image = it.k)"""


def _filtered(spark: SparkSession, d: str) -> DataFrame:
    items = views.items(spark, d).join(views.labels(spark, d).select("ident", "label_text"), "ident", "left")
    return quality.quality_filter(items, views.provenance(spark, d))


@query(f"WITH {LABELS_SQL}, {_REFUSE} SELECT key, reason FROM refused")
def pf7_quality_filter(spark: SparkSession, d: str) -> DataFrame:
    return _filtered(spark, d)


@query(f"WITH {LABELS_SQL}, {_REFUSE} SELECT coalesce(reason, 'kept') AS reason, count(*) AS items FROM refused GROUP BY 1")
def pf8_reasons(spark: SparkSession, d: str) -> DataFrame:
    return quality.reasons(_filtered(spark, d))


@query(f"WITH {LABELS_SQL} SELECT image, record_id, method, confidence FROM rec")
def sc6_merged_provenance(spark: SparkSession, d: str) -> DataFrame:
    return views.provenance(spark, d).drop("ident")


@query(f"WITH {ITEMS_SQL} SELECT regexp_replace(trim(lower(source)), '[\\s_\\-]+', '-', 'g') AS source, method, count(*) AS records FROM (SELECT DISTINCT record_id, source, method FROM box_records) GROUP BY 1, 2")
def ag10_method_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "box_records").select("record_id", "source", "method").distinct()
    return reports.method_counts(rows.withColumn("source", plain_name(F.col("source"))))


def _six(x: str) -> str:
    """Six decimals, rounded half up on the shortest decimal form of the double."""
    return f"round(({x})::DOUBLE::VARCHAR::DECIMAL(30, 20), 6)::DECIMAL(12, 6)::VARCHAR"


# Proposals from the detections of an image in pixels of a 640 x 480 frame: width and place follow class and score.
_PROPOSALS = """prop AS (SELECT image_id AS image, row_number() OVER (PARTITION BY image_id ORDER BY det_id) - 1 AS pos, (class_id * 20.0)::DOUBLE AS x1, (class_id * 10.0)::DOUBLE AS y1, class_id * 20.0 + 400 * score AS x2, class_id * 10.0 + 300 * score AS y2, score AS confidence, det_id
  FROM detections WHERE severity = 0 AND NOT isnan(score) AND score BETWEEN 0 AND 1)"""


def _proposals(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "detections").where("severity = 0 AND score >= 0 AND score <= 1")
    at = F.col("class_id") * F.lit(20.0), F.col("class_id") * F.lit(10.0)
    return rows.select(
        F.col("image_id").alias("image"), F.col("det_id").alias("pos"), at[0].alias("x1"), at[1].alias("y1"), (at[0] + 400 * F.col("score")).alias("x2"), (at[1] + 300 * F.col("score")).alias("y2"), F.col("score").alias("confidence")
    )


@query(
    f"""WITH {_PROPOSALS}, n AS (SELECT image, count(*) AS n FROM prop GROUP BY 1)
SELECT image, round(x1, 6) AS x1, round(y1, 6) AS y1, round(x2, 6) AS x2, round(y2, 6) AS y2, confidence, n > 1 AS multibox FROM prop JOIN n USING (image) WHERE confidence >= 0.5 QUALIFY row_number() OVER (PARTITION BY image ORDER BY confidence DESC, pos) = 1"""
)
def pf14_best_proposal(spark: SparkSession, d: str) -> DataFrame:
    best = autobox.best_proposal(_proposals(spark, d), 0.5)
    return best.select("image", *[F.round(F.col(f"box.{c}"), 6).alias(c) for c in ("x1", "y1", "x2", "y2")], "confidence", "multibox")


@query(
    f"""WITH {_PROPOSALS}, n AS (SELECT image, count(*) AS n FROM prop GROUP BY 1),
best AS (SELECT image, class_id_.* EXCLUDE (image, n, pos, det_id), n > 1 AS multibox FROM (SELECT prop.*, n.n FROM prop JOIN n USING (image) WHERE confidence >= 0.5 QUALIFY row_number() OVER (PARTITION BY image ORDER BY confidence DESC, pos) = 1) class_id_),
img AS (SELECT image_id AS image, min(class_id) AS c FROM detections GROUP BY 1),
b AS (SELECT image, CASE WHEN best.confidence IS NOT NULL THEN 'dino' WHEN c BETWEEN 1 AND 4 THEN 'birefnet' ELSE 'centerbox' END AS method, best.confidence, multibox, c, best.x1, best.y1, best.x2, best.y2 FROM img LEFT JOIN best USING (image)),
r AS (SELECT image, method, confidence, multibox, CASE method WHEN 'dino' THEN x1 WHEN 'birefnet' THEN 10.0 * c ELSE 64.0 END::DOUBLE AS x1, CASE method WHEN 'dino' THEN y1 WHEN 'birefnet' THEN 5.0 * c ELSE 48.0 END::DOUBLE AS y1,
  CASE method WHEN 'dino' THEN x2 WHEN 'birefnet' THEN 300.0 + c ELSE 576.0 END::DOUBLE AS x2, CASE method WHEN 'dino' THEN y2 WHEN 'birefnet' THEN 200.0 + c ELSE 432.0 END::DOUBLE AS y2 FROM b)
SELECT image, method, confidence, CASE WHEN multibox THEN 'multibox' WHEN method = 'centerbox' THEN 'centerbox' ELSE '' END AS flags,
  concat_ws(' ', '0', {_six("(x1 + x2) / 2 / 640")}, {_six("(y1 + y2) / 2 / 480")}, {_six("(x2 - x1) / 640")}, {_six("(y2 - y1) / 480")}) AS line
FROM r"""
)
def pf15_box_chain(spark: SparkSession, d: str) -> DataFrame:
    """Boxes for all images of detections: from proposals, else from masks made of the smallest class, of which some cover too little or too much."""
    images = table(spark, d, "detections").groupBy(F.col("image_id").alias("image")).agg(F.min("class_id").alias("c"), F.lit(640).alias("width"), F.lit(480).alias("height"))
    corners = F.struct((F.col("c") * 10).alias("x1"), (F.col("c") * 5).alias("y1"), (F.col("c") + 300).alias("x2"), (F.col("c") + 200).alias("y2"))
    masks = images.select("image", (F.col("c") * 61_440).alias("mask_area"), corners.alias("box"))
    done = autobox.chain(images.drop("c"), autobox.best_proposal(_proposals(spark, d), 0.5), masks)
    box = tuple(F.col(f"box.{c}") for c in ("x1", "y1", "x2", "y2"))
    return done.select("image", "method", "confidence", F.array_join("flags", "|").alias("flags"), bx.label_line(F.lit(0), box, F.lit(640), F.lit(480)).alias("line"))


# ---------------------------------------------------------------- remap

_MAP = """m0 AS (SELECT source, lower(trim(e.key)) AS label, e.value AS target, 0 AS rank FROM (SELECT source, unnest(map_entries(mapping)) AS e FROM source_specs)
  UNION ALL SELECT source, lower(trim(x)), 'DROP', 1 FROM (SELECT source, unnest(drops) AS x FROM source_specs)),
map AS (SELECT source, label, arg_min(target, rank) AS target FROM m0 GROUP BY 1, 2)"""


@query(f"WITH {_MAP} SELECT source, label, target FROM map")
def pf2_label_map(spark: SparkSession, d: str) -> DataFrame:
    return remap.label_map(table(spark, d, "source_specs"))


def _routed(spark: SparkSession, d: str) -> DataFrame:
    from siftlane.functions.idents import item_ident, source_of_ident

    files = table(spark, d, "item_files").select("path", source_of_ident(item_ident(F.col("path"))).alias("source"))
    return remap.route(files.where("source IS NOT NULL"), remap.label_map(table(spark, d, "source_specs")))


@query(
    rf"""WITH {_MAP}, p AS (SELECT DISTINCT path, split_part({views.ident_sql('url_decode(path)')}, '__', 1) AS source, list_reverse(string_split(replace(path, '\', '/'), '/'))[2:] AS up FROM item_files),
s AS (SELECT path, source, unnest(range(len(up))) AS n, lower(trim(unnest(up))) AS label FROM p), h AS (SELECT path, s.source, arg_min(target, n) AS target FROM s JOIN map ON map.source = s.source AND map.label = s.label WHERE s.label NOT LIKE '.%' GROUP BY 1, 2)
SELECT path, source, target FROM p LEFT JOIN h USING (path, source) WHERE source <> ''"""
)
def pf1_route(spark: SparkSession, d: str) -> DataFrame:
    return _routed(spark, d)


_REWRITE = f"""{_MAP}, nm AS (SELECT source, cls.class_id AS idx, m.target, c2.class_id AS new_id FROM cls JOIN map m ON m.label = cls.target LEFT JOIN cls c2 ON c2.target = m.target),
rw AS (SELECT image, pos, nm.target, CASE WHEN new_id IS NOT NULL THEN concat_ws(' ', new_id::VARCHAR, array_to_string(p[2:], ' ')) END AS line FROM tok LEFT JOIN nm ON nm.source = tok.source AND nm.idx = tok.class_id)"""


def _rewritten(spark: SparkSession, d: str) -> DataFrame:
    lookup = remap.label_map(table(spark, d, "source_specs"))
    classes = views.class_table(spark)
    names = lookup.select("source").distinct().crossJoin(classes).select("source", F.col("class_id").alias("idx"), F.col("target").alias("label"))
    return remap.rewritten_lines(views.labels(spark, d), names, lookup, classes)


@query(f"WITH {LABELS_SQL}, {_REWRITE} SELECT image, pos, target, line FROM rw")
def pf3_rewrite(spark: SparkSession, d: str) -> DataFrame:
    return _rewritten(spark, d).select("image", F.col("pos").cast("bigint").alias("pos"), "target", "line")


@query(f"WITH {LABELS_SQL}, {_REWRITE} SELECT image, coalesce(string_agg(line, chr(10) ORDER BY pos), '') AS label_text, count(line) AS kept, count(*) FILTER (target = 'DROP') AS dropped FROM rw GROUP BY 1")
def pf3_labels(spark: SparkSession, d: str) -> DataFrame:
    return remap.rewritten_labels(_rewritten(spark, d))


_MAJOR = """major AS (SELECT image, CASE WHEN n > 0 THEN target ELSE 'wilderness' END AS target FROM (SELECT image, target, count(line) AS n, min(pos) AS first FROM rw GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY image ORDER BY (n > 0) DESC, n DESC, first) = 1)"""


@query(f"WITH {LABELS_SQL}, {_REWRITE}, {_MAJOR} SELECT image, target FROM major")
def pf4_majority(spark: SparkSession, d: str) -> DataFrame:
    return remap.majority_target(_rewritten(spark, d))


@query(f"WITH {LABELS_SQL}, {_REWRITE}, {_MAJOR} SELECT cls.target, count(image) AS images FROM cls LEFT JOIN major ON major.target = cls.target GROUP BY 1")
def ag9_remap_counts(spark: SparkSession, d: str) -> DataFrame:
    return remap.class_totals(remap.majority_target(_rewritten(spark, d)), views.class_table(spark))


@query(
    """WITH m AS (SELECT manifest_id, any_value(class_counts) AS c FROM remap_manifests GROUP BY 1), e AS (SELECT manifest_id, lower(trim(x.key)) AS name, x.value AS n FROM (SELECT manifest_id, unnest(map_entries(c)) AS x FROM m))
SELECT manifest_id, name, sum(coalesce(n, 0))::BIGINT AS n FROM e GROUP BY 1, 2"""
)
def ag9_manifest_counts(spark: SparkSession, d: str) -> DataFrame:
    once = table(spark, d, "remap_manifests").groupBy("manifest_id").agg(F.max_by("class_counts", "remapped_at").alias("c"))
    return once.select("manifest_id", F.explode(remap.manifest_class_counts(F.col("c"))).alias("name", "n"))


@query(
    """WITH i AS (SELECT DISTINCT image FROM items), f AS (SELECT DISTINCT path FROM item_files WHERE path LIKE '%.txt')
SELECT image, path AS label_path FROM i LEFT JOIN f ON path = regexp_replace(image, '\\.[^./]*$', '.txt')"""
)
def pf5_label_lookup(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "item_files").where("path LIKE '%.txt'").select("path").distinct()
    return remap.label_files(table(spark, d, "items").select("image").distinct(), files)


@query(
    rf"""WITH {ITEMS_SQL}, f AS (SELECT DISTINCT i.image AS path, source, class_name AS target, regexp_extract(i.image, '([^/]*)$', 1) AS name FROM (SELECT DISTINCT key, image FROM items) i JOIN it ON it.k = i.key),
g AS (SELECT *, substr(md5(path), 1, 2) || CASE WHEN substr(md5(path), 3, 1) BETWEEN '1' AND '3' THEN '__' || substr(md5(path), 3, 1) ELSE '' END AS stem, regexp_extract(name, '(\.[^.]*)$', 1) AS suffix FROM f),
own AS (SELECT source, target, regexp_replace(stem, '__[0-9]+$', '') AS stem, list(DISTINCT regexp_extract(stem, '__([0-9]+)$', 1)::BIGINT) AS taken FROM g WHERE stem LIKE '%\_\_%' ESCAPE '\' GROUP BY 1, 2, 3),
n AS (SELECT g.*, row_number() OVER (PARTITION BY source, target, g.stem ORDER BY path) - 1 AS k, coalesce(taken, []) AS taken FROM g LEFT JOIN own USING (source, target, stem))
SELECT path, target || '/' || source || '__' || stem || CASE WHEN k = 0 THEN '' ELSE '__' || list_filter(range(1, k + len(taken) + 1), lambda x: NOT list_contains(taken, x))[k] END || suffix AS destination FROM n"""
)
def pf6_dest_names(spark: SparkSession, d: str) -> DataFrame:
    """Destinations of images that have been renamed to two letters of their hash, some with a number behind, so that many collide, also with tagged names."""
    keys = views.items(spark, d).join(table(spark, d, "items").select("key", "image").distinct(), "key")
    digit = F.substring(F.md5("image"), 3, 1)
    letters = F.concat(F.substring(F.md5("image"), 1, 2), F.when(digit.between("1", "3"), F.concat(F.lit("__"), digit)).otherwise(""))
    # The order among equal names is that of the original paths, which the new path ends with behind a mark that is cut again.
    files = keys.select("image", letters.alias("stem"), F.regexp_extract("image", r"(\.[^.]*)$", 1).alias("suffix"), "source", F.col("class_name").alias("target")).distinct()
    marked = files.select(F.concat(F.col("image"), F.lit("/"), "stem", "suffix").alias("path"), "source", "target")
    named = remap.destination_names(marked)
    return named.select(F.regexp_replace("path", r"/[^/]*$", "").alias("path"), "destination")


@query(f"WITH {ITEMS_SQL} SELECT it.source, count(*) AS items FROM it JOIN source_specs s ON s.source = it.source WHERE annotation_type = 'cls' GROUP BY 1")
def pf13_boxed_sources(spark: SparkSession, d: str) -> DataFrame:
    cls = table(spark, d, "source_specs").where("annotation_type = 'cls'").select("source")
    return views.items(spark, d).join(F.broadcast(cls), "source", "left_semi").groupBy("source").agg(F.count("*").alias("items"))


# ---------------------------------------------------------------- duplicates and groups


def _hashed(spark: SparkSession, d: str) -> DataFrame:
    """``key, source, prio, h``: documents by similarity hash; the order of sources is that of their names, none last."""
    ship_package(spark)
    docs = table(spark, d, "documents").select(F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("key"), F.coalesce(plain_name(F.col("source")), F.lit("~")).alias("source"), similarity_hash(F.col("text")).alias("h"))
    return Scratch(spark, "hashes").keep(docs.withColumn("prio", F.col("source")), "docs")


_HASH = """doc AS (SELECT lpad(doc_id::VARCHAR, 12, '0') AS key, coalesce(nullif(regexp_replace(trim(lower(source)), '[\\s_\\-]+', '-', 'g'), ''), '~') AS source, text FROM documents),
w AS (SELECT key, unnest(list_filter(string_split_regex(lower(text), '[\\s\\x{00a0}\\x{0085}\\x{2028}]+'), lambda x: x <> '')) AS word FROM doc),
wc AS (SELECT key, ('0x' || substr(md5(word), 1, 16))::UBIGINT AS t, count(*) AS n FROM w GROUP BY 1, 2),
bits AS (SELECT key, b, sum(CASE WHEN (t >> b) & 1 = 1 THEN n ELSE -n END) AS s FROM wc, range(64) r(b) GROUP BY 1, 2),
hash AS (SELECT key, source, coalesce(h, 0)::UBIGINT AS h FROM doc LEFT JOIN (SELECT key, sum(CASE WHEN s > 0 THEN (1::UBIGINT << b)::HUGEINT ELSE 0 END) AS h FROM bits GROUP BY 1) USING (key)),
ranked AS (SELECT *, row_number() OVER (ORDER BY source, key) AS rn FROM hash)"""


@query(f"WITH {_HASH} SELECT key, printf('%016x', h) AS h FROM hash")
def dd1_simhash(spark: SparkSession, d: str) -> DataFrame:
    return _hashed(spark, d).select("key", F.lower(F.lpad(F.hex("h"), 16, "0")).alias("h"))


_GREEDY = f"""{_HASH}, hs AS (SELECT list(h ORDER BY rn) AS hs, list(key ORDER BY rn) AS ks FROM ranked),
step(i, kept, ids, hit) AS (SELECT 0::BIGINT, []::UBIGINT[], []::BIGINT[], 0::BIGINT UNION ALL
  SELECT i + 1, CASE WHEN f = 0 THEN list_append(kept, h) ELSE kept END, CASE WHEN f = 0 THEN list_append(ids, i + 1) ELSE ids END, CASE WHEN f = 0 THEN 0 ELSE ids[f] END
  FROM (SELECT i, kept, ids, hs[i + 1] AS h, coalesce(list_position(list_transform(kept, lambda x: bit_count(xor(x, hs[i + 1])) <= 2), true), 0) AS f FROM step, hs WHERE i < len(hs))),
dd AS (SELECT r.key, hit = 0 AS kept, o.key AS duplicate_of, CASE WHEN hit > 0 THEN bit_count(xor(r.h, o.h))::INT END AS distance FROM (SELECT i, hit FROM step WHERE i > 0) s JOIN ranked r ON r.rn = s.i LEFT JOIN ranked o ON o.rn = hit)"""


@query(f"WITH RECURSIVE {_GREEDY} SELECT key, kept, duplicate_of, distance FROM dd")
def dd2_dedup(spark: SparkSession, d: str) -> DataFrame:
    return dedup.greedy_dedup(spark, _hashed(spark, d))


def _kept(spark: SparkSession, d: str) -> DataFrame:
    hashed = _hashed(spark, d)
    return hashed.join(dedup.greedy_dedup(spark, hashed).where("kept").select("key"), "key", "left_semi")


_NEAR = "ne AS (SELECT a.key AS key_a, b.key AS key_b, bit_count(xor(a.h, b.h))::INT AS distance, a.source AS sa, b.source AS sb FROM ranked a JOIN ranked b ON a.rn < b.rn AND bit_count(xor(a.h, b.h)) BETWEEN 3 AND 8 WHERE a.key IN (SELECT key FROM dd WHERE kept) AND b.key IN (SELECT key FROM dd WHERE kept))"


@query(f"WITH RECURSIVE {_GREEDY}, {_NEAR} SELECT key_a, key_b, distance FROM ne")
def dd3_near_edges(spark: SparkSession, d: str) -> DataFrame:
    return dedup.near_edges(_kept(spark, d))


@query(f"WITH RECURSIVE {_GREEDY}, {_NEAR} SELECT sa AS left_source, sb AS right_source, count(*) AS n FROM ne GROUP BY 1, 2")
def dd4_near_matrix(spark: SparkSession, d: str) -> DataFrame:
    return dedup.near_matrix(_kept(spark, d))


@query(
    f"""WITH {ITEMS_SQL}, p AS (SELECT DISTINCT {views.ident_sql('duplicate_of')} AS g, {views.ident_sql('key')} AS m FROM dropped_dups)
SELECT a.source AS left_source, b.source AS right_source, count(*) AS n FROM p JOIN it a ON a.id = g JOIN it b ON b.id = m GROUP BY 1, 2"""
)
def dd4_overlap(spark: SparkSession, d: str) -> DataFrame:
    from siftlane.functions.idents import item_ident

    pairs = table(spark, d, "dropped_dups").select(item_ident(F.col("duplicate_of")).alias("kept"), item_ident(F.col("key")).alias("gone")).distinct()
    return dedup.source_matrix(pairs, views.items(spark, d).select(F.col("ident").alias("key"), "source"), "kept", "gone")


@query("""SELECT DISTINCT source FROM (SELECT regexp_replace(trim(lower(source)), '[\\s_\\-]+', '-', 'g') AS source FROM box_records UNION ALL SELECT regexp_replace(trim(lower(source)), '[\\s_\\-]+', '-', 'g') FROM documents)
WHERE source <> '' AND source NOT IN (SELECT source FROM source_specs)""")
def dd5_unknown_sources(spark: SparkSession, d: str) -> DataFrame:
    """Sources of box records and documents that have no priority among the sources of items; those of documents have none."""
    named = table(spark, d, "box_records").select("source").unionByName(table(spark, d, "documents").select("source"))
    return dedup.unknown_sources(named.select(plain_name(F.col("source")).alias("source")).where("source IS NOT NULL"), table(spark, d, "source_specs"))


_DISTINCT_HASHES = f"WITH {_HASH}, x AS (SELECT DISTINCT h FROM hash)"


@query(f"{_DISTINCT_HASHES} SELECT (SELECT count(*) FROM x) AS hashes, (SELECT min(bit_count(xor(a.h, b.h)))::INT FROM x a JOIN x b ON a.h < b.h AND bit_count(xor(a.h, b.h)) <= 8) AS nearest")
def px9_separation(spark: SparkSession, d: str) -> DataFrame:
    """How many different hashes there are, and the least distance between two of them where that is at most 8."""
    hashes = Scratch(spark, "separation").keep(_hashed(spark, d).select("h").distinct(), "hashes")
    return hashes.agg(F.count("*").alias("hashes")).crossJoin(dedup.nearest(hashes, dedup.NEAR))


@query(f"WITH RECURSIVE {EDGES_SQL}, {reach_sql('e')} SELECT key, group_id FROM comp")
def gr1_components(spark: SparkSession, d: str) -> DataFrame:
    return graph.components(spark, views.pool_edges(spark, d))


_STRATA = """mem AS (SELECT it.k AS key, class_name, source, coalesce(group_id, it.k) AS group_id FROM it LEFT JOIN comp ON comp.key = it.k),
strat AS (SELECT group_id, source, class_name FROM (SELECT group_id, source, class_name, count(*) AS n FROM mem GROUP BY 1, 2, 3) QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY n DESC, source, class_name) = 1)"""


@query(f"WITH RECURSIVE {EDGES_SQL}, {reach_sql('e')}, {_STRATA} SELECT group_id, source, class_name FROM strat")
def gr2_primary_stratum(spark: SparkSession, d: str) -> DataFrame:
    return graph.primary_stratum(graph.group_ids(spark, views.items(spark, d), views.pool_edges(spark, d)))


# ---------------------------------------------------------------- sampling, balancing, splitting


@query(f"WITH {ITEMS_SQL} SELECT k AS key, class_name FROM it QUALIFY row_number() OVER (PARTITION BY class_name ORDER BY md5('42:sample:' || class_name || ':' || k), k) <= 50")
def bl1_sample(spark: SparkSession, d: str) -> DataFrame:
    pool = views.items(spark, d).select("key", "class_name").withColumn("n", F.lit(50))
    return balance.hash_sample(pool, ["class_name"], "n", "sample").drop("n")


_ALLOC = f"""caps AS (SELECT source, e.key AS class_name, e.value AS source_cap FROM (SELECT source, unnest(map_entries(cap)) AS e FROM source_specs)),
pool AS (SELECT class_name, source, count(*) AS n FROM it WHERE source <> '{WILD[0]}' GROUP BY 1, 2),
sz AS (SELECT p.class_name, p.source, n AS all_items, least(n, coalesce(source_cap, n))::BIGINT AS size FROM pool p LEFT JOIN caps c ON c.source = p.source AND c.class_name = p.class_name),
q1 AS (SELECT *, sum(size) OVER c AS total, count(*) OVER c AS sources, {CAP} * size / sum(size) OVER c AS quota FROM sz WINDOW c AS (PARTITION BY class_name)),
q2 AS (SELECT *, floor(quota)::BIGINT AS base, CASE WHEN sources <= {CAP} AND floor(quota) = 0 AND size > 0 THEN 1 ELSE least(floor(quota)::BIGINT, size) END AS given FROM q1),
q3 AS (SELECT *, size - given AS room, {CAP} - sum(given) OVER (PARTITION BY class_name) AS remaining FROM q2),
alloc AS (SELECT class_name, source, all_items, size, CASE WHEN total <= {CAP} THEN size ELSE given + least(room, greatest(remaining - coalesce(sum(room) OVER (PARTITION BY class_name ORDER BY quota - base DESC, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0)) END::BIGINT AS take FROM q3),
s1 AS (SELECT it.k, it.class_name, it.source, take FROM it JOIN alloc USING (class_name, source) QUALIFY row_number() OVER (PARTITION BY class_name, source ORDER BY md5('42:srccap:' || class_name || ':' || source || ':' || k), k) <= size),
s2 AS (SELECT k FROM s1 QUALIFY row_number() OVER (PARTITION BY class_name, source ORDER BY md5('42:cap:' || class_name || ':' || source || ':' || k), k) <= take),
bal AS (SELECT k AS key, class_name, source, source = '{WILD[0]}' OR k IN (SELECT k FROM s2) AS kept FROM it)"""


def _balanced(spark: SparkSession, d: str) -> DataFrame:
    caps = table(spark, d, "source_specs").select("source", F.explode("cap").alias("class_name", "source_cap"))
    pool = Scratch(spark, "pool").keep(views.items(spark, d).select("key", "class_name", "source"), "items")
    return balance.balance(pool, CAP, exempt=WILD, source_caps=caps)


@query(f"WITH {ITEMS_SQL}, {_ALLOC} SELECT class_name, source, size, take FROM alloc")
def bl3_allocate(spark: SparkSession, d: str) -> DataFrame:
    caps = table(spark, d, "source_specs").select("source", F.explode("cap").alias("class_name", "source_cap"))
    counts = views.items(spark, d).where(~F.col("source").isin(WILD)).groupBy("class_name", "source").agg(F.count("*").alias("n"))
    sized = counts.join(caps, ["source", "class_name"], "left").select("class_name", "source", F.least("n", F.coalesce("source_cap", "n")).cast("bigint").alias("size"))
    return balance.allocate(sized, CAP)


@query(f"WITH {ITEMS_SQL}, {_ALLOC} SELECT key, class_name, source, kept FROM bal")
def bl4_balance(spark: SparkSession, d: str) -> DataFrame:
    return _balanced(spark, d)


@query(f"WITH {ITEMS_SQL}, {_ALLOC} SELECT class_name, source, count(*) FILTER (kept) AS kept, count(*) FILTER (NOT kept) AS dropped FROM bal GROUP BY 1, 2")
def ag7_balance_counts(spark: SparkSession, d: str) -> DataFrame:
    return balance.balance_counts(_balanced(spark, d))


@query(f"WITH {ITEMS_SQL}, {_ALLOC} SELECT class_name, count(*) FILTER (kept) AS kept FROM bal GROUP BY 1 HAVING count(*) FILTER (kept) < {FLOOR}")
def ag8_floor(spark: SparkSession, d: str) -> DataFrame:
    return balance.below_floor(_balanced(spark, d), FLOOR)


@query(
    f"""WITH {LABELS_SQL}, i AS (SELECT it.k AS key, class_name, method FROM it JOIN rec ON rec.image = it.k), n AS (SELECT class_name, method, ceil(count(*) * 0.1 - 1e-9) AS wanted FROM i GROUP BY 1, 2)
SELECT key, class_name, method FROM i JOIN n USING (class_name, method) QUALIFY row_number() OVER (PARTITION BY class_name, method ORDER BY md5('42:review:' || class_name || ':' || method || ':' || key), key) <= wanted"""
)
def bl5_review_sample(spark: SparkSession, d: str) -> DataFrame:
    rows = views.items(spark, d).join(views.provenance(spark, d).select("ident", "method"), "ident").select("key", "class_name", "method")
    return balance.review_sample(rows, ["class_name", "method"], 0.1)


@query(
    f"""WITH {LABELS_SQL}, i AS (SELECT it.k AS key, class_name, CASE WHEN class_name IN ('paper', 'plastic') THEN 0.2 ELSE 0.1 END AS f FROM it JOIN rec ON rec.image = it.k), n AS (SELECT class_name, ceil(count(*) * max(f) - 1e-9) AS wanted FROM i GROUP BY 1)
SELECT key, class_name FROM i JOIN n USING (class_name) QUALIFY row_number() OVER (PARTITION BY class_name ORDER BY md5('42:draw:' || class_name || ':' || key), key) <= wanted"""
)
def bl6_review_draw(spark: SparkSession, d: str) -> DataFrame:
    rows = views.items(spark, d).join(views.provenance(spark, d).select("ident"), "ident").select("key", "class_name")
    more = F.col("class_name").isin("paper", "plastic")
    return balance.review_sample(rows.where(more), ["class_name"], 0.2, purpose="draw").unionByName(balance.review_sample(rows.where(~more), ["class_name"], 0.1, purpose="draw"))


@query(f"WITH {ITEMS_SQL} SELECT k AS key, class_name, source, CASE WHEN source = '{LEAVE_OUT}' THEN 'test' WHEN source = '{WILD[0]}' THEN 'wild_test' END AS split FROM it")
def sp1_leave_out(spark: SparkSession, d: str) -> DataFrame:
    return split.route_sources(views.items(spark, d).drop("ident"), LEAVE_OUT, WILD)


_POOL = f"""pool AS (SELECT * FROM it WHERE source NOT IN ('{LEAVE_OUT}', '{WILD[0]}')), pe AS (SELECT * FROM e WHERE key_a IN (SELECT k FROM pool) AND key_b IN (SELECT k FROM pool))"""
_POOL_GROUPS = f"""mem AS (SELECT pool.k AS key, class_name, source, coalesce(group_id, pool.k) AS group_id FROM pool LEFT JOIN comp ON comp.key = pool.k),
strat AS (SELECT group_id, source, class_name FROM (SELECT group_id, source, class_name, count(*) AS n FROM mem GROUP BY 1, 2, 3) QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY n DESC, source, class_name) = 1),
el AS (SELECT *, row_number() OVER (PARTITION BY source, class_name ORDER BY md5('42:clean_holdout:' || source || ':' || class_name || ':' || group_id), group_id) AS place, floor(count(*) OVER (PARTITION BY source, class_name) * {CLEAN_FRACTION} + 0.5) AS take
  FROM strat WHERE source IN ('{CLEAN[0]}', '{CLEAN[1]}')), clean AS (SELECT group_id FROM el WHERE place <= take)"""


@query(f"WITH RECURSIVE {EDGES_SQL}, {_POOL}, {reach_sql('pe')}, {_POOL_GROUPS} SELECT group_id FROM clean")
def sp3_clean_holdout(spark: SparkSession, d: str) -> DataFrame:
    pool = views.items(spark, d).where(~F.col("source").isin(LEAVE_OUT, *WILD))
    strata = graph.primary_stratum(graph.group_ids(spark, pool, views.pool_edges(spark, d)))
    return split.clean_holdout(strata, CLEAN, CLEAN_FRACTION)


def _split(spark: SparkSession, d: str) -> DataFrame:
    pool = views.items(spark, d).select("key", "class_name", "source")
    return split.split_items(spark, pool, views.pool_edges(spark, d), LEAVE_OUT, WILD, CLEAN, CLEAN_FRACTION, VAL)


# Without pairs every group has one stratum, and the running count of a stratum is a window.
@query(
    f"""WITH {ITEMS_SQL}, p AS (SELECT * FROM it WHERE source NOT IN ('{LEAVE_OUT}', '{WILD[0]}')), o AS (SELECT *, row_number() OVER w - 1 AS before, floor(count(*) OVER (PARTITION BY source, class_name) * {VAL} + 0.5) AS target FROM p
  WINDOW w AS (PARTITION BY source, class_name ORDER BY md5('42:split:' || source || ':' || class_name || ':' || k), k))
SELECT k AS key, source, class_name, CASE WHEN before < target THEN 'val' ELSE 'train' END AS split FROM o"""
)
def sp4_trainval(spark: SparkSession, d: str) -> DataFrame:
    pool = views.items(spark, d).where(~F.col("source").isin(LEAVE_OUT, *WILD)).select("source", "class_name", F.col("key").alias("group_id"))
    done = split.train_val(spark, pool, pool, VAL)
    return pool.join(done, "group_id").withColumnRenamed("group_id", "key")


_SEQUENTIAL = f"""tv AS (SELECT * FROM mem WHERE group_id NOT IN (SELECT group_id FROM clean)),
st AS (SELECT source, class_name, floor(count(*) * {VAL} + 0.5)::BIGINT AS target, row_number() OVER (ORDER BY source, class_name) AS j FROM tv GROUP BY 1, 2),
gv AS (SELECT group_id, map_from_entries(list((j, n))) AS m FROM (SELECT group_id, j, count(*) AS n FROM tv JOIN st USING (source, class_name) GROUP BY 1, 2) GROUP BY 1),
gl AS (SELECT group_id, j AS own, m, row_number() OVER (ORDER BY source, class_name, md5('42:split:' || source || ':' || class_name || ':' || group_id), group_id) AS i FROM gv JOIN strat USING (group_id) JOIN st USING (source, class_name)),
gs AS (SELECT list(own ORDER BY i) AS os, list(m ORDER BY i) AS ms FROM gl), tg AS (SELECT list(target ORDER BY j) AS ts FROM st),
step(i, counts, val) AS (SELECT 0::BIGINT, list_transform(ts, lambda x: 0::BIGINT), false FROM tg UNION ALL
  SELECT i + 1, CASE WHEN t THEN list_transform(range(1, len(counts) + 1), lambda k: counts[k] + coalesce(m[k], 0)) ELSE counts END, t FROM (SELECT i, counts, ms[i + 1] AS m, counts[os[i + 1]] < ts[os[i + 1]] AS t FROM step, gs, tg WHERE i < len(os)))"""


@query(
    f"""WITH RECURSIVE {EDGES_SQL}, {_POOL}, {reach_sql('pe')}, {_POOL_GROUPS}, {_SEQUENTIAL}
SELECT key, class_name, source, CASE WHEN val THEN 'val' ELSE 'train' END AS split, tv.group_id FROM tv JOIN gl ON gl.group_id = tv.group_id JOIN step ON step.i = gl.i
UNION ALL SELECT key, class_name, source, 'clean_test', group_id FROM mem WHERE group_id IN (SELECT group_id FROM clean)
UNION ALL SELECT k, class_name, source, CASE WHEN source = '{LEAVE_OUT}' THEN 'test' ELSE 'wild_test' END, NULL FROM it WHERE source IN ('{LEAVE_OUT}', '{WILD[0]}')"""
)
def sp5_split(spark: SparkSession, d: str) -> DataFrame:
    return _split(spark, d)


_RECORDED = f"""{ITEMS_SQL}, {_VAL_TRUTH}, rec AS (SELECT run_id, k AS key, class_name, source, s.sp AS split FROM cur JOIN it USING (id))"""


def _recorded(spark: SparkSession, d: str) -> DataFrame:
    """The current assignments of all recorded runs: ``run_id, key, class_name, source, split``."""
    from siftlane.functions.idents import item_ident, split_name

    now = F.struct("assigned_at", split_name(F.col("split")).alias("split"))
    rows = table(spark, d, "split_results").groupBy("run_id", item_ident(F.col("key")).alias("ident")).agg(F.max(now).alias("now"))
    return rows.join(views.items(spark, d), "ident").select("run_id", "key", "class_name", "source", "now.split")


@query(f"WITH {_RECORDED} SELECT split, class_name, count(*) AS items FROM rec GROUP BY 1, 2")
def ag5_split_counts(spark: SparkSession, d: str) -> DataFrame:
    return split.split_counts(_recorded(spark, d))


@query(
    f"""WITH {_RECORDED} SELECT a.split, b.class_name, c.source, count(rec.key) AS items FROM (SELECT DISTINCT split FROM rec) a, (SELECT DISTINCT class_name FROM rec) b, (SELECT DISTINCT source FROM rec) c
LEFT JOIN rec ON rec.split = a.split AND rec.class_name = b.class_name AND rec.source = c.source GROUP BY 1, 2, 3"""
)
def ag6_composition(spark: SparkSession, d: str) -> DataFrame:
    return split.dense_composition(_recorded(spark, d))


@query(f"WITH {_RECORDED} SELECT split, class_name, source, count(*) AS items FROM rec GROUP BY CUBE (split, class_name, source)")
def ag6_cube(spark: SparkSession, d: str) -> DataFrame:
    return _recorded(spark, d).cube("split", "class_name", "source").agg(F.count("*").alias("items"))


# ---------------------------------------------------------------- evaluation and reports

# Figures of a class at a severity, from detections at the threshold.
_METRICS = f"""mt AS (SELECT severity, class_id, round(avg(correct::INT) FILTER (score >= {TAU}), 6) AS precision, round(count(*) FILTER (correct AND score >= {TAU}) / nullif(count(*) FILTER (correct), 0), 6) AS recall FROM scored GROUP BY 1, 2)"""


def _metrics(spark: SparkSession, d: str) -> DataFrame:
    over = F.col("score") >= TAU
    return views.scored(spark, d).groupBy("severity", "class_id").agg(
        F.round(F.avg(F.when(over, F.col("correct").cast("int"))), 6).alias("precision"), F.round(F.count_if(F.col("correct") & over) / F.nullif(F.count_if("correct"), F.lit(0)), 6).alias("recall")
    )


@query(f"WITH {DETS_SQL}, {_METRICS} SELECT severity || ':' || class_id AS cell, 'precision' AS metric, precision AS value FROM mt UNION ALL SELECT severity || ':' || class_id, 'recall', recall FROM mt")
def ag13_metrics(spark: SparkSession, d: str) -> DataFrame:
    wide = _metrics(spark, d).select(F.concat_ws(":", F.col("severity").cast("string"), F.col("class_id").cast("string")).alias("cell"), "precision", "recall")
    return evaluate.tidy_metrics(wide, "cell")


@query(
    f"""WITH {DETS_SQL}, {_METRICS}, c AS (SELECT target AS class_name, precision AS map50, recall, coalesce(precision >= 0.75 AND recall >= 0.7, false) AS passed FROM cls LEFT JOIN mt ON mt.class_id = cls.class_id AND severity = 0 AND target <> 'organic')
SELECT *, bool_and(passed) OVER () AND (SELECT avg(precision) >= 0.8 FROM mt WHERE severity = 0) AS all_passed FROM c"""
)
def ag14_escalation(spark: SparkSession, d: str) -> DataFrame:
    """The verdict on clean frames; one class is left without metrics on purpose."""
    clean = Scratch(spark, "metrics").keep(_metrics(spark, d).where("severity = 0"), "clean")
    overall = clean.agg(F.avg("precision")).first()[0] or 0.0
    classes = views.class_table(spark)
    named = clean.join(classes, "class_id").where("target <> 'organic'").select(F.col("target").alias("class_name"), F.col("precision").alias("map50"), "recall")
    return evaluate.escalation(named, classes.select(F.col("target").alias("class_name")), overall)


@query(f"WITH {_RECORDED}, t AS (SELECT split AS tier, class_name, count(*) AS items FROM rec WHERE split IN ('val', 'clean_test', 'test') GROUP BY 1, 2) SELECT tier, class_name, items FROM t WHERE tier = 'clean_test'")
def ag15_headline(spark: SparkSession, d: str) -> DataFrame:
    tiers = _recorded(spark, d).where("split IN ('val', 'clean_test', 'test')").groupBy(F.col("split").alias("tier"), "class_name").agg(F.count("*").alias("items"))
    return evaluate.headline(tiers)


@query(f"WITH {DETS_SQL}, {_METRICS} SELECT severity, round(avg(precision), 8) AS value FROM mt GROUP BY 1")
def wn10_severity_curve(spark: SparkSession, d: str) -> DataFrame:
    m = _metrics(spark, d).groupBy("severity").agg(F.round(F.avg("precision"), 8).alias("value"))
    return evaluate.severity_curve(m.where("severity > 0"), m.where("severity = 0"))


@query(f"WITH {DETS_SQL}, {_METRICS} SELECT severity, class_id, precision, recall FROM mt WHERE severity = (SELECT max(severity) FROM mt)")
def wn9_worst_tier(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.worst_tier(_metrics(spark, d))


@query(
    f"""WITH {DETS_SQL}, {_METRICS}, t AS (SELECT CASE severity WHEN 0 THEN 'val' WHEN 1 THEN 'test1' ELSE 'test2_s' || severity END AS tier, severity, target AS class_name, precision AS map50 FROM mt JOIN cls USING (class_id) WHERE target <> 'metal' OR severity > 0),
k AS (SELECT * FROM t WHERE tier IN ('val', 'test1') OR severity = (SELECT max(severity) FROM t))
SELECT a.tier, cls.target AS class_name, coalesce(map50, 0.0) AS map50 FROM (SELECT DISTINCT tier FROM k) a CROSS JOIN cls LEFT JOIN k ON k.tier = a.tier AND k.class_name = cls.target"""
)
def fig_tier_comparison(spark: SparkSession, d: str) -> DataFrame:
    """Figures by tier and class; one class is left out of val on purpose."""
    name = F.when(F.col("severity") == 0, "val").when(F.col("severity") == 1, "test1").otherwise(F.concat(F.lit("test2_s"), F.col("severity").cast("string")))
    tiers = _metrics(spark, d).join(F.broadcast(views.class_table(spark)), "class_id").select(name.alias("tier"), "severity", F.col("target").alias("class_name"), F.col("precision").alias("map50"))
    return evaluate.tier_comparison(tiers.where("class_name <> 'metal' OR severity > 0"), views.class_table(spark).select(F.col("target").alias("class_name")))


@query(
    f"""WITH {DETS_SQL}, s AS (SELECT t.class_id IS NOT NULL AS known, image_id, severity, max(score) AS score FROM dets JOIN truth t USING (object) GROUP BY 1, 2, 3)
SELECT known, least(floor(score * 40), 39)::INT AS bin, count(*) AS n FROM s GROUP BY 1, 2"""
)
def fig_separation(spark: SparkSession, d: str) -> DataFrame:
    """Top scores of known and unknown objects by cell."""
    known = views.truth(spark, d).select("object", F.col("class_id").isNotNull().alias("known"))
    top = views.detections(spark, d).join(known, "object").groupBy("known", "image_id", "severity").agg(F.max("score").alias("score"))
    return top.groupBy("known", F.least(F.floor(F.col("score") * 40), F.lit(39)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


@query(
    """WITH p AS (SELECT date_diff('day', DATE '2025-01-01', logged_at::DATE)::INT AS epoch, round(avg(score), 6) AS fitness FROM detections WHERE logged_at IS NOT NULL AND NOT isnan(score) AND score BETWEEN 0 AND 1 GROUP BY 1)
SELECT epoch, fitness FROM p ORDER BY fitness DESC, epoch LIMIT 1"""
)
def wn8_best_epoch(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "detections").where("logged_at IS NOT NULL AND score >= 0 AND score <= 1")
    epochs = rows.groupBy(F.datediff(F.col("logged_at").cast("date"), F.lit("2025-01-01").cast("date")).alias("epoch")).agg(F.round(F.avg("score"), 6).alias("fitness"))
    return evaluate.best_epoch(epochs, "fitness")


@query(
    f"""WITH {_RECORDED}, r AS (SELECT run_id, max(assigned_at) AS mtime FROM split_results GROUP BY 1), n AS (SELECT run_id, (count(*) FILTER (split = 'val') - 20)::INT AS epoch FROM rec GROUP BY 1)
SELECT run_id, mtime, epoch FROM r JOIN n USING (run_id) WHERE epoch >= 0 ORDER BY mtime DESC, run_id LIMIT 1"""
)
def wn11_resumable(spark: SparkSession, d: str) -> DataFrame:
    mtime = table(spark, d, "split_results").groupBy("run_id").agg(F.max("assigned_at").alias("mtime"))
    epochs = _recorded(spark, d).groupBy("run_id").agg((F.count_if(F.col("split") == "val") - 20).cast("int").alias("epoch"))
    return evaluate.resumable_run(mtime.join(epochs, "run_id"))


@query(f"WITH {ITEMS_SQL} SELECT s.source, license, coalesce(role, 'training') AS role, format('{{:,}}', count(it.k)) AS images, priority FROM source_specs s LEFT JOIN it ON it.source = s.source GROUP BY 1, 2, 3, 5")
def ag17_census(spark: SparkSession, d: str) -> DataFrame:
    return reports.census(table(spark, d, "source_specs"), views.items(spark, d))


@query(
    """WITH f AS (SELECT source, unnest(range(len(map_entries(mapping)))) AS pos, unnest(map_entries(mapping)) AS e FROM source_specs)
SELECT source, e.value AS target, string_agg(e.key, ', ' ORDER BY pos) AS labels, (min(pos) + CASE WHEN e.value = 'DROP' THEN 1000000 ELSE 0 END)::INT AS place FROM f GROUP BY 1, 2"""
)
def ag18_mapping_rows(spark: SparkSession, d: str) -> DataFrame:
    return reports.mapping_rows(table(spark, d, "source_specs"))


@query(f"WITH {LABELS_SQL} SELECT image FROM labels INTERSECT SELECT image FROM rec")
def so1_intersection(spark: SparkSession, d: str) -> DataFrame:
    return views.labels(spark, d).select("image").intersect(views.provenance(spark, d).select("image"))


@query(f"WITH {LABELS_SQL} SELECT k AS image FROM it EXCEPT SELECT image FROM rec")
def so2_missing(spark: SparkSession, d: str) -> DataFrame:
    return views.items(spark, d).select(F.col("key").alias("image")).join(views.provenance(spark, d).select("image"), "image", "left_anti")


@query("WITH m AS (SELECT source, unnest(drops) AS label FROM source_specs UNION SELECT source, e.key FROM (SELECT source, unnest(map_entries(mapping)) AS e FROM source_specs) WHERE e.value = 'DROP') SELECT source, label FROM m")
def so3_drop_union(spark: SparkSession, d: str) -> DataFrame:
    specs = table(spark, d, "source_specs")
    mapped = specs.select("source", F.explode("mapping").alias("label", "target")).where("target = 'DROP'").select("source", "label")
    return specs.select("source", F.explode("drops").alias("label")).unionByName(mapped).distinct()


@query("SELECT key FROM items GROUP BY 1 HAVING count(*) > 1")
def so4_repeated(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "items").groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
