from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from siftlane.llm import mixing as mx
from tests.conftest import rows


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    words = {"news": "market bank rate price share".split(), "mail": "hello regards dear thanks meeting".split(), "code": "def return import class lambda".split()}
    spell = {"news": ["news", " NEWS", "News "], "mail": ["mail"], "code": ["code", "Code"]}
    out = []
    for i in range(600):
        s = rng.choices(["news", "mail", "code"], [6, 1, 3])[0]
        out.append((i, " ".join(rng.choice(words[s]) for _ in range(rng.randint(20, 60))), rng.choice(spell[s]) if i % 11 else None))
    return [*out, (900, None, "news"), (901, "", None)]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, "doc_id bigint, text string, source string")


GOALS = [(1, "news", 0.4, 2, 0.5), (1, "mail", 0.3, 1, 0.5), (1, "code", 0.3, 2, 0.5), (2, "news", 0.2, 1, 0.3), (2, "code", 0.6, 3, 0.3), (2, "Odd Source", 0.2, 5, 0.3)]


@pytest.fixture(scope="module")
def goals(spark):
    return spark.createDataFrame(GOALS, "mix_id int, source string, target_weight double, max_repeat int, size_factor double")


def test_shares_and_shortfalls(spark, docs, goals, corpus):
    mix = mx.mix_sources(spark, docs, goals)
    tokens = Counter()
    total = 0
    for _, text, source in corpus:
        n = len(mx.token_ids(text))
        total += n
        if source:
            tokens[source.strip().lower()] += n
    short = {(m, s) for m, s, w, r, f in GOALS if w * f * total > r * tokens[s]}
    every = mix.shares.collect()
    for m in (1, 2):
        mine = [r for r in every if r["mix_id"] == m]
        assert sum(r["actual_share"] for r in mine) == pytest.approx(1) and sum(r["source"] is None for r in mine) == 1
        assert all(r["settled"] for r in mine) and mine[0]["missed"] < 0.02
    shares = [r for r in every if r["source"] is not None]
    assert {(r["mix_id"], r["source"]) for r in shares if r["short"]} == short and len(shares) == len(GOALS)
    assert (2, "Odd Source") in short and (1, "mail") in short
    for r in shares:
        if not r["short"]:
            assert abs(r["tokens"] / r["target_tokens"] - 1) < 0.25
            assert abs(r["expected_tokens"] / r["target_tokens"] - 1) < 0.03
        else:
            assert r["tokens"] == r["max_repeat"] * tokens[r["source"].strip().lower()]
    copies = mix.copies.collect()
    source_of = {i: (s or "").strip().lower() for i, _, s in corpus}
    most = {(m, s): r for m, s, _, r, _ in GOALS}
    assert all(0 < r["copies"] <= most.get((r["mix_id"], source_of[r["doc_id"]]), 5) for r in copies)
    assert len({(r["mix_id"], r["doc_id"]) for r in copies}) == len(copies)


def test_classifier_on_held_out_rows(spark, docs, corpus):
    from pyspark.sql import functions as F

    from siftlane.functions.idents import plain_name

    named = docs.select("doc_id", "text", plain_name(F.col("source")).alias("domain"))
    domains = ["code", "mail", "news"]
    model = mx.fit_classifier(named.where("doc_id % 2 = 0"), domains)
    held = [(t, s) for i, t, s in corpus if i % 2 and t and s]
    right = sum(domains[int(np.argmax(mx.posterior(mx._counts(mx.token_ids(t)), None, model)))] == s.strip().lower() for t, s in held)
    assert right / len(held) > 0.95


def test_posteriors_add_up():
    model = (np.log(np.full(3, 1 / 3)), np.log(np.full((3, mx.FEATURES), 1 / mx.FEATURES)))
    for label in (None, 0, 2):
        p = mx.posterior(np.zeros(mx.FEATURES), label, model)
        assert p.sum() == pytest.approx(1) and (p >= 0).all()


def test_rounding_keeps_many_equal_domains():
    for n in (1, 3, 8, 150, 1000):
        p = mx.rounded(np.full(n, 1 / n), mx.grid_of(n))
        assert p.sum() == pytest.approx(1) and abs(p - 1 / n).max() <= 1 / mx.grid_of(n) + 1e-12
        assert abs(p * n - 1).max() <= 0.05 + 1e-9 or n < 5


def test_fit_against_a_dense_solution(spark):
    """A box-constrained least squares of few documents, solved densely by many small steps."""
    rng = np.random.default_rng(3)
    n, d = 40, 3
    p = np.array([mx.rounded(x, 100) for x in rng.dirichlet([0.3] * d, n)])
    t = rng.integers(20, 200, n)
    cells = spark.createDataFrame([(x.tolist(), -1, int(y)) for x, y in zip(p, t, strict=True)], "p array<double>, label int, tokens bigint")
    targets, caps = np.array([[0.3, 0.3, 0.2]]) * t.sum(), np.full((1, d), 2.0)
    fit = mx.fit_rates(cells, targets, caps, t @ p)
    weight = 1 / targets[0] ** 2
    r = np.full(n, 0.5)
    for _ in range(20_000):
        r = np.clip(r - 2e3 / t * 0.5 * t * (p @ (weight * ((t * r) @ p - targets[0]))), 0, np.floor(p @ caps[0] + 1e-9))
    dense = np.abs((t * r) @ p - targets[0]).sum() / targets.sum()
    assert fit.still.all() and fit.miss[0] <= dense + 1e-3


def test_pieces_of_long_texts(monkeypatch):
    text = " ".join(f"word{i} and more" for i in range(400)) + "\n\nIt’s 12,5 °C"
    whole = mx.token_ids(text)
    monkeypatch.setattr(mx, "PIECE", 100)
    assert mx.token_ids(text) == whole and mx.token_ids(None) == [] == mx.token_ids("")


def test_empty(spark, docs, goals):
    mix = mx.mix_sources(spark, docs.where("false"), goals)
    named = mix.shares.where("source IS NOT NULL")
    assert mix.copies.count() == 0 and named.count() == len(GOALS)
    assert rows(named, "mix_id", "source", "tokens") == {(m, s, 0) for m, s, *_ in GOALS}


def test_extra_columns_with_clashing_names(spark, docs, goals):
    from pyspark.sql import functions as F

    clash = lambda df, *cols: df.withColumns({c: F.lit("x") for c in cols if c not in df.columns})
    mix = mx.mix_sources(spark, clash(docs, "domain", "p", "label", "n_tokens", "mix_id", "copies"), clash(goals, "spelled", "domain", "tokens", "short"))
    assert mix.shares.where("source IS NOT NULL").count() == len(GOALS) and mix.copies.count() > 0
