from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from siftlane.functions.idents import has_label, item_ident, plain_name, split_name

SPELLINGS = [
    "paper/milltray__scan (7).jpg", " paper/milltray__scan (7).jpg  ", "PAPER/MILLTRAY__SCAN (7).JPG", "paper\\milltray__scan (7).jpg", "paper__milltray__scan (7).jpg",
    "data/interim/remapped/paper/milltray__scan (7).jpg", "./paper/milltray__scan (7)", "milltray__scan (7).png", "file:///x/paper/../paper/milltray__scan%20(7).webp", "milltray%5F%5Fscan%20(7).txt",
]


@pytest.mark.parametrize("text", SPELLINGS)
def test_spellings_of_one_item(spark, text):
    df = spark.createDataFrame([(text,)], "k string")
    assert df.select(item_ident(F.col("k"))).first()[0] == "milltray__scan(7)"


@pytest.mark.parametrize("text", [None, "", "  ", "paper/"])
def test_nothing_named(spark, text):
    assert spark.createDataFrame([(text,)], "k string").select(item_ident(F.col("k"))).first()[0] is None


def test_malformed_escape_stays(spark):
    assert spark.createDataFrame([("a__b%zz.jpg",)], "k string").select(item_ident(F.col("k"))).first()[0] == "a__b%zz"


def test_names(spark):
    df = spark.createDataFrame([(" Wild-test ", "QA reports"), (None, " ")], "a string, b string")
    assert [tuple(r) for r in df.select(split_name(F.col("a")), plain_name(F.col("b"))).collect()] == [("wild_test", "qa-reports"), (None, None)]


def test_labels(spark):
    df = spark.createDataFrame([(x,) for x in ["a.txt", "", " ", "-", "NaN", "None", "n/a", None]], "l string")
    assert [r[0] for r in df.select(has_label(F.col("l"))).collect()] == [True] + [False] * 7
