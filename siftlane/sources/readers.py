"""Readers with declared schemas for the files that operators consume; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftlane.functions.idents import IMAGE_SUFFIXES
from siftlane.operators.checks import DataError, require_none, require_unique

DETECTIONS = T.StructType([
    T.StructField("image_id", T.StringType()), T.StructField("object_id", T.StringType()), T.StructField("class_id", T.IntegerType()),
    T.StructField("score", T.DoubleType()), T.StructField("severity", T.IntegerType()),
])
PROVENANCE = T.StructType([
    T.StructField("image", T.StringType()), T.StructField("source", T.StringType()), T.StructField("method", T.StringType()),
    T.StructField("confidence", T.DoubleType()), T.StructField("flags", T.ArrayType(T.StringType())),
])
SWEEP = T.StructType([
    T.StructField("tau_frame", T.DoubleType()), T.StructField("min_votes", T.IntegerType()), T.StructField("high_water", T.DoubleType()),
    T.StructField("wrong_bin_rate", T.DoubleType()), T.StructField("rest_rate", T.DoubleType()), T.StructField("chosen", T.IntegerType()),
])
# The ways a box can have been made.
METHODS = ("dino", "birefnet", "centerbox")


def _json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_detections(spark: SparkSession, path: str, nonempty: bool = False) -> DataFrame:
    """Detections as JSON lines; a missing or mistyped field is an error, an empty file only with ``nonempty``."""
    df = _json(spark, path, DETECTIONS)
    require_none(df.where(" OR ".join(f"{f.name} IS NULL" for f in DETECTIONS.fields)), "detections with missing fields")
    if nonempty and not df.take(1):
        raise DataError(f"no detections in {path}")
    return df


def read_provenance(spark: SparkSession, path: str) -> DataFrame:
    """Boxing provenance as JSON lines with ``stem``; repeated stems and unknown methods are errors, missing flags are none."""
    df = _json(spark, path, PROVENANCE).withColumn("flags", F.coalesce("flags", F.array().cast("array<string>")))
    require_none(df.where(~F.col("method").isin(*METHODS)).select("image", "method"), "unknown boxing methods")
    df = df.withColumn("stem", F.regexp_replace(F.substring_index("image", "/", -1), r"\.[^.]*$", ""))
    require_unique(df, ["stem"], "repeated stems in provenance")
    return df


def merge_provenance(groups: DataFrame) -> DataFrame:
    """Provenance of several groups (``grp, stem, ...``): for a stem the row of the last group."""
    last = F.row_number().over(Window.partitionBy("stem").orderBy(F.col("grp").desc()))
    return groups.withColumn("rn", last).where("rn = 1").drop("rn")


def read_sweep(spark: SparkSession, path: str) -> DataFrame:
    """A sweep as CSV with exactly the known header, at least one row, ``chosen`` 0 or 1."""
    header = spark.read.option("header", False).csv(path).first()
    names = [f.name for f in SWEEP.fields]
    if header is None or list(header) != names:
        raise DataError(f"{path}: the header must be {names}")
    df = spark.read.schema(SWEEP).option("header", True).option("mode", "FAILFAST").csv(path)
    if not df.take(1):
        raise DataError(f"{path}: no rows")
    require_none(df.where("chosen IS NULL OR chosen NOT IN (0, 1)"), "chosen must be 0 or 1")
    return df


def read_training_metrics(spark: SparkSession, path: str) -> DataFrame:
    """A metrics table as CSV: any numeric columns, headers trimmed, with ``epoch``."""
    raw = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    df = raw.toDF(*[c.strip() for c in raw.columns])
    if "epoch" not in df.columns or not df.take(1):
        raise DataError(f"{path}: needs the column epoch and at least one row")
    numbers = df.select(*[F.col(f"`{c}`").try_cast("double").alias(c) for c in df.columns])
    require_none(numbers.where(" OR ".join(f"`{c}` IS NULL" for c in numbers.columns)), f"{path}: not a number")
    return numbers.withColumn("epoch", F.col("epoch").cast("int"))


def scan_items(spark: SparkSession, root: str, classes: tuple[str, ...]) -> DataFrame:
    """``key, class_name, source, image, label``: the tree ``root/<class>/<source>__<name>.<suffix>`` with the label files beside.

    A class without folder and an image without ``__`` are errors. Only names are read, not the files.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for c in classes:
        if not fs.exists(hadoop.Path(f"{root}/{c}")):
            raise DataError(f"no folder for class {c} under {root}")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load([f"{root}/{c}" for c in classes]).select("path")
    named = files.select("path", F.element_at(F.split("path", "/"), -2).alias("class_name"), F.substring_index("path", "/", -1).alias("file"))
    named = named.withColumn("stem", F.regexp_replace("file", r"\.[^.]*$", "")).withColumn("suffix", F.lower(F.substring_index("file", ".", -1)))
    images = named.where(F.col("suffix").isin(*IMAGE_SUFFIXES))
    require_none(images.where(~F.contains("stem", F.lit("__"))).select("path"), "images without a source in their name")
    labels = named.where("suffix = 'txt'").select("class_name", "stem", F.col("path").alias("label"))
    joined = images.join(labels, ["class_name", "stem"], "left")
    return joined.select(F.concat_ws("/", "class_name", "file").alias("key"), "class_name", F.substring_index("file", "__", 1).alias("source"), F.col("path").alias("image"), "label")


def split_index(assignments: DataFrame) -> DataFrame:
    """``stem, key, split, group_id`` of a split; two keys of one stem are an error. assignments: ``key, split, group_id``."""
    stem = F.regexp_replace(F.substring_index("key", "/", -1), r"\.[^.]*$", "")
    df = assignments.select(stem.alias("stem"), "key", "split", "group_id")
    require_unique(df, ["stem"], "stems shared by several keys")
    return df


def read_split(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The rows of one split of a finished set, by name; an empty or unknown split is an error. Only its partition is read."""
    df = spark.read.parquet(path).where(F.col("split") == name)
    if not df.take(1):
        raise DataError(f"{path} has no rows for the split {name}")
    return df.orderBy("name")
