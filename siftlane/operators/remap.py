"""From the labels of sources to the target classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftlane.functions.boxes import label_lines
from siftlane.operators.checks import require_none

DROP = "DROP"


def label_map(specs: DataFrame) -> DataFrame:
    """``source, label, target``: the mapping of each source in lower case, its drops folded in where the mapping is silent.

    Two spellings of a label that lead to different targets are an error.
    """
    mapped = specs.select("source", F.explode("mapping").alias("label", "target"))
    flat = mapped.select("source", F.lower(F.trim("label")).alias("label"), "target", F.lit(0).alias("rank"))
    clash = flat.groupBy("source", "label").agg(F.countDistinct("target").alias("n")).where("n > 1")
    require_none(clash, "labels with several targets")
    drops = specs.select("source", F.explode("drops").alias("label")).select("source", F.lower(F.trim("label")).alias("label"), F.lit(DROP).alias("target"), F.lit(1).alias("rank"))
    return flat.unionByName(drops).groupBy("source", "label").agg(F.min_by("target", "rank").alias("target"))


def route(paths: DataFrame, lookup: DataFrame) -> DataFrame:
    """``path, source, target``: the target of the nearest folder whose name the source maps; NULL where none is.

    paths: ``path, source``; hidden folders (with a leading dot) are passed over. Folders are tried from the file upwards.
    """
    parts = F.split(F.translate("path", "\\\\", "/"), "/")
    folders = F.filter(F.reverse(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))), lambda s: (s != "") & ~F.startswith(s, F.lit(".")))
    steps = paths.select("path", "source", F.posexplode(folders).alias("up", "folder")).withColumn("label", F.lower(F.trim("folder")))
    hit = steps.join(lookup, ["source", "label"]).groupBy("path", "source").agg(F.min_by("target", "up").alias("target"))
    return paths.select("path", "source").distinct().join(hit, ["path", "source"], "left")


def unmapped(routed: DataFrame) -> DataFrame:
    return routed.where("target IS NULL").select("source", "path")


def rewritten_lines(labels: DataFrame, names: DataFrame, lookup: DataFrame, classes: DataFrame) -> DataFrame:
    """``image, pos, source, target, line``: every label line with its target class; ``line`` has the new id and the other tokens as they were.

    labels: ``image, source, label_text``; names: ``source, idx, label`` (the class list of a source); classes: ``target, class_id``. Lines of
    dropped labels have the target ``DROP`` and no new line. A bad or unknown id has a NULL target; `bad_lines` lists these.
    """
    lines = labels.select("image", "source", F.posexplode(label_lines(F.col("label_text"))).alias("pos", "raw"))
    tokens = F.split(F.trim("raw"), r"\s+")
    lines = lines.withColumn("tokens", tokens).withColumn("idx", F.get("tokens", F.lit(0)).try_cast("int"))
    named = names.join(lookup, ["source", "label"], "left").join(classes, "target", "left").select("source", "idx", "target", "class_id")
    joined = lines.join(named, ["source", "idx"], "left")
    rest = F.slice("tokens", F.lit(2), F.greatest(F.size("tokens") - 1, F.lit(0)))
    line = F.when(F.col("class_id").isNotNull(), F.concat_ws(" ", F.col("class_id").cast("string"), F.array_join(rest, " ")))
    return joined.select("image", "pos", "source", "target", line.alias("line"))


def bad_lines(rewritten: DataFrame) -> DataFrame:
    return rewritten.where("target IS NULL").select("image", "pos")


def rewritten_labels(rewritten: DataFrame) -> DataFrame:
    """``image, label_text, kept, dropped`` per image, lines in their order."""
    lines = F.array_sort(F.collect_list(F.when(F.col("line").isNotNull(), F.struct("pos", "line"))))
    return rewritten.groupBy("image").agg(
        F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("label_text"), F.count("line").alias("kept"), F.count_if(F.col("target") == DROP).alias("dropped")
    )


def majority_target(rewritten: DataFrame) -> DataFrame:
    """``image, target``: the class most kept lines have, the first in the file on ties; ``wilderness`` for an image without kept lines."""
    counts = rewritten.groupBy("image", "target").agg(F.count("line").alias("n"), F.min("pos").alias("first"))
    order = Window.partitionBy("image").orderBy((F.col("n") > 0).desc(), F.col("n").desc(), "first")
    top = counts.withColumn("rn", F.row_number().over(order)).where("rn = 1")
    return top.select("image", F.when(F.col("n") > 0, F.col("target")).otherwise("wilderness").alias("target"))


def label_files(images: DataFrame, files: DataFrame) -> DataFrame:
    """``image, label_path``: the text file beside an image, else the one where its last ``images`` folder is ``labels``; NULL without either.

    images: ``image`` (a path); files: ``path`` of text files.
    """
    stem = F.regexp_replace("image", r"\.[^./]*$", ".txt")
    swapped = F.regexp_replace(stem, r"(?i)^(.*(?:/|^))images(/(?:(?!images/)[^\n])*)$", "$1labels$2")
    wanted = images.select("image", stem.alias("beside"), F.when(swapped != stem, swapped).alias("other"))
    near = files.select(F.col("path").alias("beside"), F.col("path").alias("p1"))
    far = files.select(F.col("path").alias("other"), F.col("path").alias("p2"))
    return wanted.join(near, "beside", "left").join(far, "other", "left").select("image", F.coalesce("p1", "p2").alias("label_path"))


def destination_names(files: DataFrame) -> DataFrame:
    """``path, destination``: ``<source>__<stem><tag><suffix>`` in the target's folder; no two files of a source share a destination's stem there.

    files: ``path, source, target``. A label goes with its image, so a stem counts whatever its suffix. Of equal stems the first by path keeps its own; the
    others get ``__1``, ``__2`` ..., without the numbers that would give them the own stem of another file. (A tagged name has its number at
    the end, so two of them are equal only if they come from one stem.)
    """
    name = F.substring_index("path", "/", -1)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    suffix = F.regexp_extract(name, r"(\.[^.]*)$", 1)
    keys = ["source", "target", "stem"]
    named = files.select("path", "source", "target", stem.alias("stem"), suffix.alias("suffix"))
    placed = named.withColumn("k", F.row_number().over(Window.partitionBy(*keys).orderBy("path")) - 1)
    # Numbers that stems of other files have taken, for the stem in front of them.
    number = F.regexp_extract("stem", r"__([1-9]\d{0,8})$", 1)
    own = named.where(number != "").select("source", "target", F.regexp_replace("stem", r"__[1-9]\d{0,8}$", "").alias("stem"), number.cast("int").alias("n")).distinct()
    taken = own.groupBy(*keys).agg(F.array_sort(F.collect_list("n")).alias("taken"))
    free = F.aggregate(F.coalesce("taken", F.array().cast("array<int>")), F.col("k"), lambda n, t: F.when(t <= n, n + 1).otherwise(n))
    tag = F.when(F.col("k") == 0, "").otherwise(F.concat(F.lit("__"), free.cast("string")))
    return placed.join(taken, keys, "left").select("path", F.concat("target", F.lit("/"), "source", F.lit("__"), "stem", tag, "suffix").alias("destination"))


def class_totals(targets: DataFrame, classes: DataFrame) -> DataFrame:
    """Images of every target class, 0 for a class without any."""
    counts = targets.groupBy("target").agg(F.count("*").alias("images"))
    return classes.select("target").join(counts, "target", "left").select("target", F.coalesce("images", F.lit(0)).alias("images"))


def manifest_class_counts(counts: Column) -> Column:
    """The entries of a class-count map in lower case, without blanks, those of one class added up, in order of the name."""
    names = F.array_sort(F.array_distinct(F.transform(F.map_keys(counts), lambda k: F.lower(F.trim(k)))))
    total = lambda name: F.aggregate(F.filter(F.map_entries(counts), lambda e: F.lower(F.trim(e["key"])) == name), F.lit(0).cast("bigint"), lambda acc, e: acc + F.coalesce(e["value"], F.lit(0)))
    return F.map_from_entries(F.transform(names, lambda n: F.struct(n.alias("key"), total(n).alias("value"))))
