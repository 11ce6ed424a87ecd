"""Ranks and running sums in a seeded order, without a group ever being ordered in one task.

The order is that of an md5 digest, so rows of any group spread evenly over the digests' first three digits. Counts per group and
prefix are a small table, over which a window gives what comes before each prefix; rows are ordered only within a prefix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGITS = 3


def running_sum(df: DataFrame, keys: list[str], digest: Column, tie: str, value: Column, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the rows of its group that come before it, by (digest, tie)."""
    cols = df.columns
    spread = df.withColumns({"_digest": digest, "_value": value.cast("bigint")}).withColumn("_prefix", F.substring("_digest", 1, DIGITS))
    totals = spread.groupBy(*keys, "_prefix").agg(F.sum("_value").alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(*keys, "_prefix", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*keys, "_prefix").orderBy("_digest", tie).rowsBetween(Window.unboundedPreceding, -1)
    summed = spread.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    return summed.join(bases, [*keys, "_prefix"]).select(*cols, (F.col("_base") + F.col("_inside")).alias(name))


def place(df: DataFrame, keys: list[str], digest: Column, tie: str, name: str = "place") -> DataFrame:
    """``df`` with its rank in its group from 1, by (digest, tie)."""
    return running_sum(df, keys, digest, tie, F.lit(1), name).withColumn(name, F.col(name) + 1)


def twister_place(df: DataFrame, keys: list[str], purpose: str, tie: str, seed: int, name: str = "place") -> DataFrame:
    """``df`` with its place in its group after a shuffle by Python's generator, seeded with ``seed:purpose:keys``.

    For results that must equal a recorded run of that generator. A group is shuffled in one task: use it on tables of moderate size.
    """
    import random

    import pandas as pd

    def shuffle(pdf: pd.DataFrame) -> pd.DataFrame:
        ordered = sorted(pdf[tie])
        label = ":".join([str(seed), purpose, *[str(pdf[k].iloc[0]) for k in keys]])
        random.Random(label).shuffle(ordered)
        at = {t: i + 1 for i, t in enumerate(ordered)}
        return pdf.assign(**{name: [at[t] for t in pdf[tie]]})

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.groupBy(*keys).applyInPandas(shuffle, f"{fields}, `{name}` int")


def twister_sample(df: DataFrame, keys: list[str], n: str, purpose: str, tie: str, seed: int) -> DataFrame:
    """At most ``n`` rows of each group, drawn by Python's generator as `twister_place` seeds it; with the same limits."""
    import random

    import pandas as pd

    def draw(pdf: pd.DataFrame) -> pd.DataFrame:
        ordered, wanted = sorted(pdf[tie]), int(pdf[n].iloc[0])
        if wanted >= len(ordered):
            return pdf
        label = ":".join([str(seed), purpose, *[str(pdf[k].iloc[0]) for k in keys]])
        return pdf[pdf[tie].isin(set(random.Random(label).sample(ordered, wanted)))]

    return df.groupBy(*keys).applyInPandas(draw, df.schema)
