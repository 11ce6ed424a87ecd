"""Writers: stage tables, review queues, finished datasets, logs."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlane.functions.idents import SPLITS
from siftlane.operators.checks import require_none


def _at(spark: SparkSession, path: str) -> tuple:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def write_note(spark: SparkSession, path: str, text: str | None) -> None:
    """A small text file in any file system that Spark reaches; None removes it."""
    where, system = _at(spark, path)
    if text is None:
        system.delete(where, False)
        return
    out = system.create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_note(spark: SparkSession, path: str) -> str | None:
    """A text file that `write_note` has written; None where there is none."""
    where, system = _at(spark, path)
    if not system.exists(where):
        return None
    stream = system.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_stage(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """A stage's table, replacing the former one; ordered, it is the same bytes for the same rows."""
    (df.orderBy(*order) if order else df).write.mode("overwrite").parquet(path)


def write_by_source(df: DataFrame, path: str) -> None:
    """Replace only the sources that ``df`` holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source").parquet(path)


def emit_dataset(split: DataFrame, path: str, classes: tuple[str, ...]) -> dict:
    """The finished set, partitioned by split, with flat names; an item without label is an error. Returns (and writes) the description.

    split: ``key, split, image, label_text``.
    """
    require_none(split.where("label_text IS NULL").select("key"), "items without a label", show=5)
    flat = split.withColumn("name", F.replace("key", F.lit("/"), F.lit("__")))
    flat.write.mode("overwrite").partitionBy("split").parquet(path)
    present = {r["split"] for r in split.select("split").distinct().collect()}
    about = {"splits": {s: f"split={s}" for s in SPLITS if s in present}, "names": dict(enumerate(classes))}
    write_note(split.sparkSession, f"{path.rstrip('/')}/_dataset.json", json.dumps(about, indent=1))
    return about


def write_review_queue(queue: DataFrame, path: str) -> None:
    """One folder per flag, rows by (confidence, image), flags joined by a bar."""
    queue.repartition("flag").sortWithinPartitions("flag", F.col("confidence").asc_nulls_first(), "image").write.mode("overwrite").partitionBy("flag").option("header", True).csv(path)


def append_run(record: dict, path: str | Path) -> None:
    """One JSON line at the end of a log; the log is never cut."""
    with open(path, "a", encoding="utf-8") as f:
        f.write(json.dumps(record, sort_keys=True, default=str) + "\n")


def write_json_lines(df: DataFrame, path: str) -> None:
    """Rows as JSON lines with sorted keys."""
    df.select(*sorted(df.columns)).write.mode("overwrite").json(path)
