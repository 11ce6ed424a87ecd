from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from siftlane.llm import leakage as lk
from tests.conftest import rows

WORDS = [f"word{i}" for i in range(500)]


def passage(seed, n=80):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def changed(text, every):
    words = text.split()
    words[::every] = ["other"] * len(words[::every])
    return " ".join(words)


P = {1: passage(1), 2: passage(2), 3: passage(3, 40)}


def half(text, share):
    words = text.split()
    return " ".join(words[: int(len(words) * share)])


CASES = {
    10: (f"before {P[1]} after", {1}),
    11: (changed(P[1], 11), {1}),
    12: ("x " * 50 + half(P[2], 0.6) + " y" * 50, {2}),
    13: (half(P[2], 0.35), set()),
    14: (" ".join(reversed(P[1].split())), set()),
    15: ("<p>" + P[1].replace(" ", "</b> <b>").upper() + "</p>", {1}),
    16: (P[3].replace("word", "wo​rd­"), {3}),
    17: ("> " + P[1].replace(" ", "\n> "), {1}),
    18: (f"{P[1]} {P[2]}", {1, 2}),
    19: (half(P[1], 0.5) + " inserted words in between" * 4 + " " + " ".join(P[1].split()[40:]), {1}),
    20: ("", set()), 21: (None, set()), 22: ("short", set()),
    23: ("filler " * 60000 + P[2], {2}),
    24: (P[1].replace("word1", "wo-\nrd1"), {1}),
}


def test_cases(spark):
    docs = spark.createDataFrame([(i, t, 0) for i, (t, _) in CASES.items()], "doc_id bigint, text string, passage_id int")
    passages = spark.createDataFrame([(p, t) for p, t in P.items()] + [(8, None), (9, ""), (7, "too short to count")], "passage_id bigint, text string")
    want = {(i, p) for i, (_, ps) in CASES.items() for p in ps}
    found = rows(lk.find_leaks(spark, docs, passages), "doc_id", "passage_id", "share")
    assert {f[:2] for f in found} == want
    assert rows(lk.find_leaks(spark, docs.repartition(7), passages.repartition(3)), "doc_id", "passage_id", "share") == found
    assert rows(lk.too_short(passages), "passage_id", "words") == {(7, 4), (8, 0), (9, 0)}


def test_stock_frames_are_no_leak(spark):
    rng = random.Random(5)
    frame = "in view {} the {} covers the lower part of the {} and nobody could explain it. "
    fill = lambda: "".join(frame.format(*[rng.choice(WORDS) for _ in range(3)]) for _ in range(6))
    passages = spark.createDataFrame([(p, fill()) for p in range(40)], "passage_id bigint, text string")
    docs = spark.createDataFrame([(d, fill()) for d in range(60)], "doc_id bigint, text string")
    assert lk.find_leaks(spark, docs, passages).count() == 0


def test_many_other_passages_change_nothing(spark):
    docs = spark.createDataFrame([(1, f"before {P[1]} after"), (2, half(P[2], 0.6)), (3, "other words")], "doc_id bigint, text string")
    more = spark.createDataFrame([*P.items(), *[(100 + k, passage(100 + k)) for k in range(300)]], "passage_id bigint, text string")
    assert rows(lk.find_leaks(spark, docs, more), "doc_id", "passage_id") == {(1, 1), (2, 2)}


def test_a_passage_of_common_seeds_is_found(spark):
    """Twenty variants of one text share nearly all seeds, which must not keep any of them from being found."""
    base = passage(7, 60).split()
    variants = [(k, " ".join([*base[:30], f"own{k}", *base[30:]])) for k in range(20)]
    docs = spark.createDataFrame([(1, variants[3][1])], "doc_id bigint, text string")
    found = rows(lk.find_leaks(spark, docs, spark.createDataFrame(variants, "passage_id bigint, text string")), "passage_id")
    assert found == {(k,) for k in range(20)}


def test_scripts_without_spaces(spark):
    rng = random.Random(2)
    text = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(60))
    docs = spark.createDataFrame([(1, "前" + text + "后"), (2, text[:20])], "doc_id bigint, text string")
    assert rows(lk.find_leaks(spark, docs, spark.createDataFrame([(5, text)], "passage_id bigint, text string")), "doc_id", "passage_id") == {(1, 5)}


def test_the_copy_behind_denser_frames(spark):
    """Stretches of stock frames come before the true copy, more of them than any fixed number of tries."""
    words = P[1].split()
    frames = " ".join(" ".join(words[k : k + 25]) + " x" * 400 for k in (0, 20, 40, 55) * 2)
    docs = spark.createDataFrame([(1, frames + " " + changed(P[1], 13))], "doc_id bigint, text string")
    assert rows(lk.find_leaks(spark, docs, spark.createDataFrame([(1, P[1])], "passage_id bigint, text string")), "doc_id") == {(1,)}


def test_long_tags():
    tag = '<span style="' + "color: red; " * 40 + '">'
    assert lk.plain_words(f"one {tag}two</span> <div class='{'x' * 500}'>three") == ["one", "two", "three"]


def test_empty_sides(spark):
    docs = spark.createDataFrame([(1, P[1])], "doc_id bigint, text string")
    passages = spark.createDataFrame([(1, P[1])], "passage_id bigint, text string")
    assert lk.find_leaks(spark, docs.where("false"), passages).count() == 0
    assert lk.find_leaks(spark, docs, passages.where("false")).count() == 0
    assert rows(lk.find_leaks(spark, docs.union(docs).withColumn("doc_id", F.monotonically_increasing_id()), passages), "passage_id", "share", "doc_id")


@pytest.mark.parametrize(("text", "words"), [("l&rsquo;été <br/>œuf-\nfrais", ["lete", "oeuffrais"]), ("ﬂat CAFÉ 0.288", ["flat", "cafe", "0288"]), (None, []), ("!!! —", [])])
def test_plain_words(text, words):
    assert lk.plain_words(text) == words
