"""Tables for reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def census(sources: DataFrame, items: DataFrame) -> DataFrame:
    """``source, license, role, images`` with thousands marks, in order of priority; a source's role is training unless it says another."""
    counts = items.groupBy("source").agg(F.count("*").alias("n"))
    joined = sources.join(counts, "source", "left")
    return joined.select("source", "license", F.coalesce("role", F.lit("training")).alias("role"), F.format_number(F.coalesce("n", F.lit(0)), 0).alias("images"), "priority")


def mapping_rows(specs: DataFrame) -> DataFrame:
    """``source, target, labels``: the labels of each target in the order of the mapping, ``DROP`` last. ``place`` orders the targets of a source."""
    flat = specs.select("source", F.posexplode(F.map_entries("mapping")).alias("pos", "e")).select("source", "pos", F.col("e.key").alias("label"), F.col("e.value").alias("target"))
    labels = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "label"))), lambda x: x["label"]), ", ")
    return flat.groupBy("source", "target").agg(F.min("pos").alias("first"), labels.alias("labels")).select(
        "source", "target", "labels", (F.col("first") + F.when(F.col("target") == "DROP", 1_000_000).otherwise(0)).cast("int").alias("place")
    )


def method_counts(records: DataFrame) -> DataFrame:
    """How many records each source has by boxing method."""
    return records.groupBy("source", "method").agg(F.count("*").alias("records"))


# Characters that LaTeX gives a meaning, and what stands for them.
_LATEX = {"\\": r"\textbackslash{}", "&": r"\&", "%": r"\%", "$": r"\$", "#": r"\#", "_": r"\_", "{": r"\{", "}": r"\}", "~": r"\textasciitilde{}", "^": r"\textasciicircum{}"}


def latex_escape(text: str) -> str:
    return "".join(_LATEX.get(c, c) for c in text)


def latex_table(rows: list[tuple], header: list[str], columns: str) -> str:
    """A tabular of few rows."""
    lines = [rf"\begin{{tabular}}{{{columns}}}", r"\toprule", " & ".join(map(latex_escape, header)) + r" \\", r"\midrule"]
    lines += [" & ".join(latex_escape(str(x)) for x in r) + r" \\" for r in rows]
    return "\n".join([*lines, r"\bottomrule", r"\end{tabular}", ""])
