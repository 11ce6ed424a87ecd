"""Session construction and the shared scratch folder that all executors can reach."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "siftlane", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and no UI; keyword dots are written as double underscores."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    base = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for key, value in (base | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset on one machine (a local master), an own folder is made once. On a cluster it
    must be set: tables in a folder of one machine can't be read by the others."""
    root = spark.conf.get("spark.checkpoint.dir", None) or getattr(spark, "_siftlane_root", None)
    if not root:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        root = "file://" + tempfile.mkdtemp(prefix="siftlane-")
        spark._siftlane_root = root
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers of a session, once; they need not have it on their path."""
    context = spark.sparkContext
    if getattr(context, "_siftlane_shipped", False):
        return
    context._siftlane_shipped = True
    package = Path(__file__).resolve().parent
    if not package.is_dir():  # it runs from the shipped file itself
        return
    sources = sorted(package.rglob("*.py"))
    digest = hashlib.sha256(b"".join(p.read_bytes() for p in sources)).hexdigest()[:16]
    root = checkpoint_root(spark)
    folder = Path(root.removeprefix("file://")) if root.startswith(("file:", "/")) else Path(tempfile.mkdtemp(prefix="siftlane-"))
    folder = Path(str(folder).removeprefix("file:"))
    folder.mkdir(parents=True, exist_ok=True)
    target = folder / f"siftlane_{digest}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sources:
            z.write(p, Path(package.name) / p.relative_to(package))
    context.addPyFile(str(target))


def _session_folder(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/siftlane/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove all tables that operators have written in this session; results that still read them are gone with them."""
    where = spark._jvm.org.apache.hadoop.fs.Path(_session_folder(spark))
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class Scratch:
    """Tables written for one run of an operator, in the shared folder.

    ``keep`` writes a DataFrame and reads it back, which cuts the lineage: a lost executor costs
    a re-read of files, never a re-run of the rounds before. ``drop`` removes a table that no
    later step reads; whatever a returned DataFrame still reads must stay.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        ship_package(spark)
        self.root = f"{_session_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(self.path(name))
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
