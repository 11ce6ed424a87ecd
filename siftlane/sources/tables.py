"""Reading the tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlane.functions.idents import item_ident


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def canonical_items(items: DataFrame) -> DataFrame:
    """One row ``(ident, key)`` per item, whatever the number of its rows; keys that name nothing are left out."""
    return items.select(item_ident(F.col("key")).alias("ident"), "key").where("ident IS NOT NULL").groupBy("ident").agg(F.min("key").alias("key"))
