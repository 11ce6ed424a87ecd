from __future__ import annotations

from pyspark.sql import functions as F

from siftlane.plans.queries import QUERIES


def test_any_number_of_sources(spark, tmp_path):
    """The second half repeats the texts of the first under sources that come later."""
    n = 10_400
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("source"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("source"), F.concat(F.lit("text "), F.md5((F.col("id") % (n // 2)).cast("string"))).alias("text"))
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["dd1_simhash"](spark, str(tmp_path)).count() == n
    got = QUERIES["dd2_dedup"](spark, str(tmp_path))
    assert got.count() == n
    assert got.where(F.col("key") >= f"{n // 2:012d}").where("kept").count() == 0
