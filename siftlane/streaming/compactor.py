"""Streaming compaction of very many tiny files into few well-sized ones.

The source is a stream of files (a table of stored files, or the files themselves through
``binaryFile``). Structured Streaming's checkpoint holds which input files were seen, so each is
discovered once. Every available batch is bound to its items, and written under
``batch=<id>``: the id comes from the checkpoint, so a batch that is retried after a failure
has the same id and the same rows and *replaces* what the failed try left behind.

``seal`` then keeps one copy of each record over all batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftlane.functions.idents import IMAGE_SUFFIXES, item_ident, unescaped
from siftlane.session import Scratch

#: Suffixes that interrupted and backed-up writes add behind the name proper.
_LEFTOVER = r"(?i)(?:\.(?:part|partial|bak|tmp|old|orig|crdownload))+$"
#: What file managers and retries add between the stem and the suffix; marks may be stacked.
_COPY_MARK = r"(?i)(?:\s*\(\d+\)|\s*-\s*copy|_copy\d*|\.copy\d*)"
_MARKS = rf"(?i)(?:{_COPY_MARK})+(\.[a-z]+)$"


def named_files(files: DataFrame) -> DataFrame:
    """Files that are images or labels by name, with the ident of their own name, and ``marked``: the name proper, where it may carry a
    copy mark."""
    rows = files.select("file_id", "n_bytes", "modified_at", "body", F.rtrim(unescaped(F.col("path"))).alias("text"))
    rows = rows.withColumn("proper", F.regexp_replace("text", _LEFTOVER, ""))
    rows = rows.withColumn("suffix", F.lower(F.substring_index("proper", ".", -1))).where(F.col("suffix").isin("txt", *IMAGE_SUFFIXES))
    may_be = F.contains("proper", F.lit("(")) | F.contains(F.lower("proper"), F.lit("copy"))
    return rows.select(
        "file_id", "n_bytes", "modified_at", "body",
        F.when(F.col("suffix") == "txt", "label").otherwise("image").alias("kind"),
        (F.length("proper") < F.length("text")).alias("leftover"),
        item_ident(F.col("proper")).alias("own"),
        F.when(may_be, F.col("proper")).alias("marked"),
    )


def bind_files(files: DataFrame, items: DataFrame) -> DataFrame:
    """Each stored file with the record it holds; files that hold none are left out.

    files: ``file_id, path, body, n_bytes, modified_at`` (more columns are ignored).
    items: ``ident, key``, one row per ident.
    A file whose own name is an item's belongs to that item. Only a file whose own name is no
    item's is looked up again with one copy mark less (``(1)``, ``- Copy``), then two, until none is left; the
    longest name that is an item's counts. So an item named ``scan (7)`` never takes part in the second join, however many of its
    kind there are. NULL paths and names of no item hold no record. A NULL body counts as empty.
    """
    named, items = named_files(files), items.select("ident", "key")
    keep = ["key", "kind", "file_id", "n_bytes", "modified_at", "leftover"]
    first = named.join(items, F.col("own") == items.ident).select(*keep, F.lit(False).alias("renamed"), "body")
    rest = named.where("marked IS NOT NULL").join(items, F.col("own") == items.ident, "left_anti")
    stack = F.regexp_extract("marked", _MARKS, 0)
    parts = rest.select("file_id", F.regexp_replace("marked", _MARKS, "").alias("stem"), F.regexp_extract_all(stack, F.lit(_COPY_MARK), F.lit(0)).alias("marks"), F.regexp_extract("marked", _MARKS, 1).alias("end")).where("size(marks) > 0")
    tried = parts.select("file_id", "stem", "marks", "end", F.explode(F.sequence(F.lit(1), F.size("marks"))).alias("less"))
    tried = tried.select("file_id", "less", item_ident(F.concat("stem", F.array_join(F.slice("marks", F.lit(1), F.size("marks") - F.col("less")), ""), "end")).alias("ident"))
    found = tried.join(items, "ident").groupBy("file_id").agg(F.min_by("key", "less").alias("key"))
    second = rest.join(found, "file_id").select(*keep, F.lit(True).alias("renamed"), "body")
    return first.unionByName(second)


def compact_stream(
    spark: SparkSession,
    stream: DataFrame,
    bind: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
) -> DataFrame:
    """Process all files available now, batch by batch, and return the log of records over all batches."""

    def write(batch: DataFrame, batch_id: int) -> None:
        bind(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id:08d}")

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return read_log(spark, out)


LOG_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("file_id", T.LongType()),
    T.StructField("n_bytes", T.IntegerType()), T.StructField("modified_at", T.TimestampNTZType()), T.StructField("leftover", T.BooleanType()),
    T.StructField("renamed", T.BooleanType()), T.StructField("body", T.BinaryType()), T.StructField("batch", T.StringType()),
])


def read_log(spark: SparkSession, out: str) -> DataFrame:
    """The records of all batches; an empty log when no batch was written."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(out)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).option("basePath", out).parquet(out)


def file_stream(spark: SparkSession, path: str, schema: T.StructType, max_bytes_per_batch: int = 8 << 30) -> DataFrame:
    """A table of stored files as a stream; a folder of part files and a single file both work."""
    folder, _, name = path.rstrip("/").rpartition("/")
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    single = where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isFile()
    reader = spark.readStream.schema(schema).option("maxBytesPerTrigger", str(max_bytes_per_batch))
    return reader.option("pathGlobFilter", name).parquet(folder) if single else reader.parquet(path)


def stored_record_log(spark: SparkSession, files_path: str, items: DataFrame, out: str | None = None, checkpoint: str | None = None, max_bytes_per_batch: int = 8 << 30) -> DataFrame:
    """Compact the stored files under ``files_path``; a second call with the same folders takes up only new files."""
    scratch = Scratch(spark, "compact")
    schema = spark.read.parquet(files_path).schema
    stream = file_stream(spark, files_path, schema, max_bytes_per_batch)
    return compact_stream(spark, stream, lambda batch: bind_files(batch, items), out or scratch.path("log"), checkpoint or scratch.path("progress"))


def seal(log: DataFrame) -> DataFrame:
    """One copy of each record, one row per item with its image and its label, in partitions of the advisory size.

    Of several copies a whole file under its own name comes before a leftover and before a renamed copy, then the
    latest, the longest, the smallest file_id. An item with an image only has a NULL label and the other way round.
    """
    order = F.struct(
        ~F.coalesce("leftover", F.lit(False)), ~F.coalesce("renamed", F.lit(False)), F.col("modified_at"), F.col("n_bytes"), -F.col("file_id")
    )
    # One aggregation by item: the bodies are shuffled once.
    best = lambda kind: F.max_by(F.struct("file_id", "body"), F.when(F.col("kind") == kind, order))
    one = log.groupBy("key").agg(best("image").alias("i"), best("label").alias("l"), F.count("*").cast("bigint").alias("copies"))
    return one.select("key", F.col("i.file_id").alias("image_file"), F.col("i.body").alias("image"), F.col("l.file_id").alias("label_file"), F.col("l.body").alias("label"), "copies").hint("rebalance")


def record_copies(log: DataFrame) -> DataFrame:
    """``key, kind, representative, file_id``: the files of each record with the smallest of them; one row per file, however many copies there are."""
    slim = log.select("key", "kind", "file_id").distinct()
    first = slim.groupBy("key", "kind").agg(F.min("file_id").alias("representative"))
    return slim.join(first, ["key", "kind"]).select("key", "kind", "representative", "file_id")


def same_record_pairs(log: DataFrame) -> DataFrame:
    """Every pair ``file_a < file_b`` of files that hold the same record, once."""
    slim = log.select("key", "kind", "file_id")
    a, b = slim.alias("a"), slim.alias("b")
    on = (F.col("a.key") == F.col("b.key")) & (F.col("a.kind") == F.col("b.kind")) & (F.col("a.file_id") < F.col("b.file_id"))
    return a.join(b, on).select(F.col("a.file_id").alias("file_a"), F.col("b.file_id").alias("file_b")).distinct()
