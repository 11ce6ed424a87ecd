"""From recorded items to a finished, balanced and split set: stages that each write a table and resume where they stopped."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftlane.functions import boxes as bx
from siftlane.functions.idents import CLASSES, item_ident
from siftlane.operators import autobox, balance, dedup, qa, quality, remap, split
from siftlane.operators.checks import require_none, require_subset, require_unique
from siftlane.plans import views
from siftlane.plans.pipeline import Halt, Stage, fingerprint, run_stages
from siftlane.sources.sinks import read_note, write_note
from siftlane.sources.tables import table
from siftlane.streaming.compactor import named_files

# Share of the boxed images of a class that people review, and the classes of which it is more; least confidence of a proposal.
REVIEWED, REVIEWED_MORE, MORE = 0.10, 0.20, ("paper", "plastic")
PROPOSAL = 0.30


@dataclass(frozen=True)
class BuildConfig:
    cap: int = 1500
    floor: int = 800
    val_fraction: float = 0.15
    leave_out: str | None = None
    wild: tuple[str, ...] = ()
    clean_sources: tuple[str, ...] = ()
    clean_fraction: float = 0.0
    seed: int = 42
    null_confidence_as: float | None = field(default=0.0)
    #: People have seen the review queue: figures of the gate that are pending or bad don't halt the run.
    ack_review: bool = True


#: Tables a data folder may have beside the given ones.
OPTIONAL = {
    "source_names": "source string, idx int, label string",
    "image_sizes": "image string, width int, height int",
    "box_proposals": "image string, pos bigint, x1 double, y1 double, x2 double, y2 double, confidence double",
    "box_masks": "image string, mask struct<h: int, w: int, data: binary>",
    "review_results": "class_name string, review_fail double, location_fail double, median_iou double",
    "image_hashes": "image string, h bigint",
}


def optional(spark: SparkSession, data: str, name: str) -> DataFrame:
    """A table of the data folder, empty where the folder hasn't it."""
    there = spark._jvm.org.apache.hadoop.fs.Path(f"{data}/{name}.parquet")
    if there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there):
        return table(spark, data, name)
    return spark.createDataFrame([], OPTIONAL[name])


def stages(spark: SparkSession, data: str, out: str, config: BuildConfig, force: bool = False) -> tuple[list[Stage], list[Stage]]:
    """items, quality, balance, split; and the steps remap, autobox, qa, dedup that ``items`` runs first, ``force`` also where they are complete.

    A stage or step is complete when its table was written whole for the same settings.
    """
    mark = fingerprint(replace(config, ack_review=True), data.encode())

    def path(name: str) -> str:
        return f"{out.rstrip('/')}/{name}"

    def complete(name: str) -> bool:
        note = read_note(spark, f"{path(name)}/_settings.json")
        return note is not None and json.loads(note).get("fingerprint") == mark

    def stage(name: str, make: Callable[[], DataFrame], hint: str, then: Callable[[], None] = lambda: None) -> Stage:
        def run() -> None:
            write_note(spark, f"{path(name)}/_settings.json", None)
            make().write.mode("overwrite").parquet(path(name))
            then()
            write_note(spark, f"{path(name)}/_settings.json", json.dumps({"fingerprint": mark}))

        return Stage(name, run, lambda: complete(name), hint)

    def read(name: str) -> DataFrame:
        return spark.read.parquet(path(name))

    specs = table(spark, data, "source_specs")

    def remapped() -> DataFrame:
        """Labels of sources with boxes of their own get the target ids; what has only dropped boxes goes to ``wilderness``."""
        lookup, classes = remap.label_map(specs), views.class_table(spark)
        require_none(lookup.where(~F.col("target").isin(remap.DROP, *CLASSES)), "mapping targets that are no class")
        given = optional(spark, data, "source_names").select("source", "idx", F.lower(F.trim("label")).alias("label"))
        plain = specs.select("source").distinct().crossJoin(classes).select("source", F.col("class_id").alias("idx"), F.col("target").alias("label"))
        names = given.unionByName(plain.join(given.select("source").distinct(), "source", "left_anti"))
        base = views.items(spark, data)
        labels = views.labels(spark, data)
        own = labels.join(F.broadcast(specs.where("annotation_type = 'cls'").select("source")), "source", "left_anti")
        lines = remap.rewritten_lines(own, names, lookup, classes)
        require_none(remap.bad_lines(lines), "label lines whose class is bad or not mapped")
        done = remap.rewritten_labels(lines).select(F.col("image").alias("key"), F.col("label_text").alias("new_text"), "dropped")
        target = remap.majority_target(lines).select(F.col("image").alias("key"), "target")
        joined = base.join(labels.select("ident", "label_text"), "ident", "left").join(done, "key", "left").join(target, "key", "left")
        return joined.select("ident", "key", F.coalesce("target", "class_name").alias("class_name"), "source", F.coalesce("new_text", "label_text").alias("label_text"), F.coalesce("dropped", F.lit(0)).alias("dropped"))

    def boxed() -> DataFrame:
        """The chain's boxes for unlabelled images of sources without boxes, where their sizes are given."""
        named = lambda t: optional(spark, data, t).withColumn("image", item_ident(F.col("image")))
        cls = specs.where("annotation_type = 'cls'").select("source")
        open_ = read("remap").where("label_text IS NULL").join(F.broadcast(cls), "source", "left_semi")
        sizes = named("image_sizes").dropDuplicates(["image"])
        images = open_.join(sizes.withColumnRenamed("image", "ident"), "ident").select(F.col("ident").alias("image"), "width", "height")
        box = autobox.mask_box(F.col("mask"))
        masks = named("box_masks").dropDuplicates(["image"]).select("image", box.alias("m")).select("image", F.col("m.area").alias("mask_area"), F.struct("m.x1", "m.y1", "m.x2", "m.y2").alias("box")).where("mask_area IS NOT NULL")
        done = autobox.chain(images, autobox.best_proposal(named("box_proposals"), PROPOSAL), masks).withColumnRenamed("image", "ident")
        about = open_.join(F.broadcast(views.class_table(spark)), F.col("class_name") == F.col("target"), "left").select("ident", F.col("key"), F.coalesce("class_id", F.lit(0)).alias("class_id"))
        sized = done.join(about, "ident").join(images.withColumnRenamed("image", "ident"), "ident")
        cut = bx.clamp(tuple(F.col(f"box.{c}") for c in ("x1", "y1", "x2", "y2")), F.col("width"), F.col("height"))
        return sized.select("ident", "key", bx.label_line(F.col("class_id"), cut, F.col("width"), F.col("height")).alias("line"), "method", "confidence", "flags")

    def labelled() -> DataFrame:
        return read("remap").join(read("autobox").select("ident", "line"), "ident", "left").withColumn("label_text", F.coalesce("label_text", "line")).drop("line")

    def provenance() -> DataFrame:
        """The records of boxes; what this run has boxed holds instead of an older one."""
        new = read("autobox").select("ident", F.col("key").alias("image"), "method", "confidence")
        old = views.provenance(spark, data).select("ident", "image", "method", "confidence")
        return old.join(new.select("ident"), "ident", "left_anti").unionByName(new)

    def checked() -> DataFrame:
        pool = labelled()
        images = provenance().join(pool.select("ident", "class_name", "source"), "ident")
        labels = pool.select(F.col("key").alias("image"), "label_text", "class_name").join(images.select("image"), "image", "left_semi")
        tame = labels.where("class_name <> 'wilderness'")
        # The placeholder class of the wilderness is apart from the statistics of the others.
        parts = [(images.where("class_name <> 'wilderness'"), tame), (images.where("class_name = 'wilderness'"), labels.where("class_name = 'wilderness'"))]
        flagged = [qa.qa_flags(i.select("image", "method", "confidence"), bx.boxes_table(t).where("ok").drop("ok")) for i, t in parts]
        return flagged[0].unionByName(flagged[1]).join(images, "image")

    def gated() -> None:
        flagged = read("qa")
        rows = flagged.withColumnRenamed("image", "key")
        more = F.col("class_name").isin(*MORE)
        sample = balance.review_sample(rows.where(more), ["class_name"], REVIEWED_MORE, config.seed).unionByName(balance.review_sample(rows.where(~more), ["class_name"], REVIEWED, config.seed))
        sample.write.mode("overwrite").parquet(path("review_sample"))
        qa.review_queue(flagged).write.mode("overwrite").parquet(path("review_queue"))
        groups = flagged.select("class_name").distinct().join(optional(spark, data, "review_results"), "class_name", "left")
        verdicts = {r["verdict"] for r in groups.select(qa.gate(F.col("review_fail"), F.col("location_fail"), F.col("median_iou")).alias("verdict")).distinct().collect()}
        if verdicts - {"pass"} and not config.ack_review:
            why = "figures wait for people's review" if "pending" in verdicts else "a class fails its figures"
            raise Halt(f"QA gate: {why}; see {path('review_queue')} and {path('review_sample')}, then run again with the review acknowledged")

    def first_copies() -> DataFrame:
        """``key, kept, duplicate_of, distance`` of the pool: by recorded drops, by given hashes, and by equal bytes where there is no hash."""
        pool = read("remap").where("class_name <> 'wilderness'")
        require_none(dedup.unknown_sources(pool, specs), "sources without a priority")
        known = table(spark, data, "dropped_dups").select(item_ident(F.col("key")).alias("ident"), item_ident(F.col("duplicate_of")).alias("of"), F.col("distance").alias("d"))
        known = known.where("ident IS NOT NULL").groupBy("ident").agg(F.min(F.struct("d", "of")).alias("x")).select("ident", "x.d", "x.of")
        recorded = pool.join(known, "ident").join(views.items(spark, data).select(F.col("ident").alias("of"), F.col("key").alias("duplicate_of")), "of", "left")
        files = named_files(table(spark, data, "item_files")).where("kind = 'image' AND NOT leftover AND length(body) > 0")
        bodies = files.groupBy(F.col("own").alias("ident")).agg(F.max_by(F.sha2("body", 256), F.struct("modified_at", "file_id")).alias("digest"))
        hashes = optional(spark, data, "image_hashes").select(item_ident(F.col("image")).alias("ident"), "h").groupBy("ident").agg(F.min("h").alias("h"))
        rest = pool.join(known, "ident", "left_anti").join(bodies, "ident", "left").join(hashes, "ident", "left").join(F.broadcast(specs.select("source", F.col("priority").alias("prio"))), "source")
        # Equal bytes are equal pixels: a hash holds for all of them.
        shared = F.coalesce("h", F.when(F.col("digest").isNotNull(), F.min("h").over(Window.partitionBy(F.coalesce("digest", "key")))))
        rest = rest.withColumn("h", shared).select("key", "prio", "digest", "h")
        near = dedup.greedy_dedup(spark, rest.where("h IS NOT NULL").select("key", "prio", "h"))
        plain = rest.where("h IS NULL").withColumn("group", F.coalesce("digest", "key"))
        first = F.min_by("key", F.struct("prio", "key")).over(Window.partitionBy("group"))
        equal = plain.withColumn("first", first).select("key", (F.col("key") == F.col("first")).alias("kept"), F.when(F.col("key") != F.col("first"), F.col("first")).alias("duplicate_of"), F.when(F.col("key") != F.col("first"), F.lit(0)).alias("distance"))
        gone = recorded.select("key", F.lit(False).alias("kept"), "duplicate_of", F.col("d").cast("int").alias("distance"))
        return gone.unionByName(near).unionByName(equal).join(rest.select("key", "prio", "h"), "key", "left")

    steps = [
        stage("remap", remapped, "the tables source_specs and, if the sources have class lists of their own, source_names"),
        stage("autobox", boxed, "the tables image_sizes, box_proposals and box_masks"),
        stage("qa", checked, "the table box_records", gated),
        stage("dedup", first_copies, "the priorities in source_specs; the tables item_files, dropped_dups and image_hashes"),
    ]

    def items() -> DataFrame:
        run_stages(steps, force=force)
        return labelled().join(read("dedup").where("kept").select("key"), "key", "left_semi").drop("dropped")

    def filtered() -> DataFrame:
        base = read("items")
        require_unique(base, ["key"], "repeated keys")
        verdict = quality.quality_filter(base, provenance(), null_confidence_as=config.null_confidence_as)
        return base.join(verdict, "key")

    def balanced() -> DataFrame:
        pool = read("quality").where("reason IS NULL")
        caps = specs.select("source", F.explode("cap").alias("class_name", "source_cap"))
        exempt = [*config.wild, *([config.leave_out] if config.leave_out else [])]
        return balance.balance(pool.select("key", "class_name", "source"), config.cap, config.seed, exempt, caps)

    def divided() -> DataFrame:
        kept = read("balance").where("kept")
        require_subset(kept, read("items"), "key", "balanced keys that are no items")
        hashed = read("dedup").where("kept AND h IS NOT NULL").select("key", "prio", "h")
        edges = views.pool_edges(spark, data).unionByName(dedup.near_edges(hashed).select("key_a", "key_b")).distinct()
        done = split.split_items(
            spark, kept.select("key", "class_name", "source"), edges, config.leave_out, list(config.wild), list(config.clean_sources), config.clean_fraction, config.val_fraction, config.seed
        )
        return done.join(read("items").select("key", "label_text"), "key", "left")

    return [
        stage("items", items, "its steps remap, autobox, qa and dedup"),
        stage("quality", filtered, "the table box_records"),
        stage("balance", balanced, "the caps in source_specs"),
        stage("split", divided, "the left-out source and the fractions"),
    ], steps


def build(spark: SparkSession, data: str, out: str, config: BuildConfig | None = None, only: str | None = None, force: bool = False, say: Callable[[str], None] = print, start: str | None = None) -> list[str]:
    """The stages that ran. ``only`` may also name a step of ``items``; ``start`` runs a stage and all behind it. `Halt` passes through where the QA gate waits for people."""
    main, steps = stages(spark, data, out, config or BuildConfig(), force)
    return run_stages(steps if only in {s.name for s in steps} else main, only, force, say, start)
