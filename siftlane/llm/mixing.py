"""Mixing sources to target weights, with soft membership.

1. A classifier is fitted to labelled rows (multinomial naive Bayes over hashed token ids) and predicts for each document how much it
   belongs to each domain. A source label is evidence of the reliability ``TRUST``; a document without one has the prediction alone.
   Posteriors are rounded to a grid that is finer the more domains there are (`grid_of`): documents of one posterior and label
   share a rate, and the table of distinct ones with their token sums stands for all documents.
2. The rates of the documents minimise the squared relative distance between expected domain token totals and targets, subject to 0 <= rate <=
   cap, by projected gradient: each step is one distributed pass, in which a rate moves against its gradient, scaled by
   what a domain's total answers with, and is put back into its bounds. Rates aren't stored: a task replays the steps so far, a short list of one
   number per mix and domain, so a lost executor loses nothing. A source that stays below its target with all its documents at the cap is taken in
   full and is left out of the misses from there on; else the others would be drawn into the gap. Steps go on until the totals stand still; what
   is missed is reported for each mix, and so is whether they did.
3. A rate becomes copies: its whole part, and one more by a hash of the document with the probability of the rest. The report is
   read off these copies, also which sources fell short: all their documents are at the cap, and their tokens don't reach the target.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlane.functions.idents import plain_name
from siftlane.session import Scratch

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Most labelled rows the classifier is fitted to, buckets of its token ids, reliability of a source label.
FIT_ROWS, FEATURES, TRUST = 20_000, 4096, 0.95
#: The totals stand still when a step moves none by more than this share of the mix; steps after which that is given up and reported.
STILL, STEPS = 1e-5, 200
#: Longest piece of a text that is encoded at once; pieces end before a space that a letter follows, where the pattern splits anyway.
PIECE = 1 << 18


@lru_cache(maxsize=2)
def _encoder(path: str):
    import base64

    import tiktoken

    if not os.path.exists(path):  # on a worker without the file: the copy that the driver has sent
        path = SparkFiles.get(os.path.basename(path))
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_ids(text: str | None, path: str = TOKENIZER) -> list[int]:
    """All token ids of a text; none for NULL."""
    if not text:
        return []
    encode = _encoder(path).encode_ordinary
    if len(text) <= PIECE:
        return encode(text)
    ids, start = [], 0
    while start < len(text):
        end = min(len(text), start + PIECE)
        while end < len(text) and not (text[end] == " " and text[end + 1 : end + 2].isalpha() and not text[end - 1].isspace()):
            end += 1
        ids += encode(text[start:end])
        start = end
    return ids


def _counts(ids: list[int]) -> np.ndarray:
    return np.bincount(np.asarray(ids, np.int64) % FEATURES, minlength=FEATURES)


def fit_classifier(docs: DataFrame, domains: list[str], path: str = TOKENIZER) -> tuple[np.ndarray, np.ndarray]:
    """(log prior, log likelihood) of the domains over token buckets, from at most about ``FIT_ROWS`` labelled rows.

    docs: ``doc_id, text, domain``. The rows are those of the smallest hashes of their id. The counts are added up where the rows are; what
    comes to the driver has one row per domain.
    """
    labelled = docs.where(F.col("domain").isin(domains))
    total = labelled.count()
    parts = max(1, -(-total // FIT_ROWS))
    sample = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) == 0).select("domain", "text")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for domain, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                sums.setdefault(domain, np.zeros(FEATURES + 1, np.int64))[:] += np.append(_counts(token_ids(text, path)), 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.int64()))], names=["domain", "n"]
        )

    partial = sample.mapInArrow(add, "domain string, n array<bigint>")
    table = np.zeros((len(domains), FEATURES + 1))
    flat = partial.select("domain", F.posexplode("n").alias("k", "n")).groupBy("domain", "k").agg(F.sum("n").alias("n"))
    for r in flat.groupBy("domain").agg(F.array_sort(F.collect_list(F.struct("k", "n"))).alias("v")).collect():
        table[domains.index(r["domain"])] = [x["n"] for x in r["v"]]
    prior = np.log(table[:, -1] + 0.5) - np.log(table[:, -1].sum() + 0.5 * len(domains))
    smooth = table[:, :-1] + 0.5
    return prior, np.log(smooth) - np.log(smooth.sum(1, keepdims=True))


def posterior(counts: np.ndarray, label: int | None, model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Membership of a document in each domain, on the grid of `grid_of`, adding up to 1."""
    prior, like = model
    # Tokens of one text are far from independent: the evidence counts as that of the square root of its length.
    size = max(1.0, float(counts.sum()))
    score = prior + like @ counts / np.sqrt(size)
    p = np.exp(score - score.max())
    p /= p.sum()
    if label is not None:
        p = (1 - TRUST) * p
        p[label] += TRUST
    return rounded(p, grid_of(len(p)))


def grid_of(domains: int) -> int:
    """Steps between 0 and 1 of a rounded posterior: an entry is off by less than a hundredth, and by less than a twentieth of an equal share."""
    return max(100, 20 * domains)


def rounded(p: np.ndarray, grid: int) -> np.ndarray:
    """``p`` in whole steps of 1/grid that add up to 1: each entry rounded down, the steps left over given to the largest remainders."""
    q = np.floor(p * grid + 1e-9)
    rest = int(round(grid - q.sum()))
    if rest > 0:
        q[np.argsort(q - p * grid, kind="stable")[:rest]] += 1
    return q / grid


def membership(docs: DataFrame, domains: list[str], model: tuple[np.ndarray, np.ndarray], path: str = TOKENIZER) -> DataFrame:
    """``doc_id, domain, n_tokens, p``: tokens and posterior of every document."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    where = {d: k for k, d in enumerate(domains)}

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, p = [], []
            for domain, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                ids = token_ids(text, path)
                n.append(len(ids))
                p.append(posterior(_counts(ids), where.get(domain), shared.value).tolist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(p, pa.list_(pa.float64()))], names=["doc_id", "domain", "n_tokens", "p"])

    return docs.select("doc_id", "domain", "text").mapInArrow(judge, f"doc_id {kind}, domain string, n_tokens long, p array<double>")


class Steps:
    """The rates of documents in mixes, as the steps that have led to them.

    caps: mixes x domains; start: the same, a first rate is posterior . start. ``moves``: for each step what is taken from posterior . move; ``full``: the
    domains whose labelled documents stay at their cap.
    """

    def __init__(self, caps: np.ndarray, start: np.ndarray) -> None:
        self.caps, self.start = caps, start
        self.moves: list[np.ndarray] = []
        self.full = np.zeros(caps.shape, bool)

    def rates(self, p: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rates, caps) of documents (rows) in mixes (columns). ``label`` is the domain's number, -1 for none: a labelled document has the
        cap of its source, another the whole part of the expected cap."""
        known = label >= 0
        most = np.where(known[:, None], self.caps.T[label], np.floor(p @ self.caps.T + 1e-9))
        r = np.clip(p @ self.start.T, 0.0, most)
        for move in self.moves:
            r = np.clip(r - p @ move.T, 0.0, most)
        return np.where(known[:, None] & self.full.T[label], most, r), most


class Fit:
    """Fitted ``steps``, the domain totals they give, the relative miss of each mix over the domains that can be met, and which mixes stand still."""

    def __init__(self, steps: Steps, got: np.ndarray, miss: np.ndarray, still: np.ndarray) -> None:
        self.steps, self.got, self.miss, self.still = steps, got, miss, still


def _totals(cells: DataFrame, steps: Steps) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(expected tokens, what they answer to a step with, room left under the caps of labelled documents), each mixes x domains. One pass; a
    task gives back one row, of a size set by mixes and domains."""
    mixes, domains = steps.caps.shape

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, mixes, domains))
        for b in batches:
            p = np.array(b.column(0).to_pylist(), float).reshape(-1, domains)
            label, t = b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False).astype(float)
            r, most = steps.rates(p, label)
            sums[0] += (t[:, None] * r).T @ p
            sums[1] += (t[:, None] * ((r > 0) & (r < most))).T @ p**2
            at = np.flatnonzero(label >= 0)
            np.add.at(sums[2].T, label[at], t[at, None] * (most - r)[at])
        yield pa.RecordBatch.from_arrays([pa.array([sums.ravel().tolist()], pa.list_(pa.float64()))], names=["x"])

    parts = cells.select("p", "label", "tokens").mapInArrow(total, "x array<double>").select(F.posexplode("x").alias("k", "x")).groupBy("k").agg(F.sum("x").alias("x")).collect()
    flat = np.zeros(3 * mixes * domains)
    for r in parts:
        flat[r["k"]] = r["x"]
    return tuple(flat.reshape(3, mixes, domains))  # type: ignore[return-value]


def fit_rates(cells: DataFrame, targets: np.ndarray, caps: np.ndarray, soft: np.ndarray) -> Fit:
    """The rates for which expected domain totals come nearest to ``targets`` (mixes x domains), within the caps.

    cells: ``p, label, tokens``; soft: expected tokens of each domain in all documents. Misses count relative to their target. A step that
    makes a mix worse is taken back by half.
    """
    scale = np.maximum(targets.sum(1, keepdims=True), 1.0)
    weight = 1.0 / np.maximum(targets, 0.01 * scale) ** 2
    steps = Steps(caps, targets / np.maximum(soft, 1.0))
    pace, least = np.ones(len(targets)), np.full(len(targets), np.inf)
    got, answer, room = _totals(cells, steps)
    still = np.zeros(len(targets), bool)
    for _ in range(STEPS):
        # Whose labelled documents are all at the cap, below the target: taken in full, and no miss from here on.
        fresh = (room <= 1e-9 * scale) & (got < targets) & ~steps.full
        if fresh.any():
            steps.full |= fresh
            least[fresh.any(1)] = np.inf
        miss = np.where(steps.full, 0.0, got - targets)
        loss = (weight * miss**2).sum(1)
        worse = loss > least * (1 + 1e-12)
        if steps.moves and worse.any():
            steps.moves[-1][worse] /= 2
            pace[worse] /= 2
        least = np.where(worse, least, loss)
        # Where hardly any document is free to move, the answer of all of them bounds the step.
        move = pace[:, None] * miss / np.maximum(np.maximum(answer, 0.05 * soft), 1.0)
        move[worse | still] = 0.0
        steps.moves.append(move)
        before = got
        got, answer, room = _totals(cells, steps)
        moved = np.abs(got - before).max(1) / scale[:, 0]
        still = ~worse & ((moved < STILL) | (pace < 1e-3)) & ~((room <= 1e-9 * scale) & (got < targets) & ~steps.full).any(1)
        if still.all():
            break
    miss = np.where(steps.full, 0.0, got - targets)
    return Fit(steps, got, np.abs(miss).sum(1) / scale[:, 0], still)


class Mix:
    """The pieces of one run: ``shares`` (the report) and ``copies`` (the mix)."""

    def __init__(self, shares: DataFrame, copies: DataFrame) -> None:
        self.shares, self.copies = shares, copies


def mix_sources(spark: SparkSession, docs: DataFrame, targets: DataFrame, path: str = TOKENIZER, seed: int = 42) -> Mix:
    """Mix ``docs`` (``doc_id, text, source``) to ``targets`` (``mix_id, source, target_weight, max_repeat, size_factor``).

    Sources in any spelling. ``copies``: ``mix_id, doc_id, copies, n_tokens`` of every document that is taken. ``shares`` has every target row, with
    ``tokens`` and ``copies`` of the source's documents, their ``actual_share`` of the mix, the ``expected_tokens`` of the domain (documents by
    membership), ``short``, and for the mix ``missed`` (summed misses of the domains that can be met, by its size) and ``settled``; and per
    mix a row with a NULL source and NULL targets for documents of none of its sources, so the actual shares of a mix that isn't empty add up to 1.

    A document without a source counts in the total size and in the domains it is predicted for. A source
    without documents can't be met unless its weight is 0. Repeated documents are rows of their own. No documents, no copies.
    """
    if os.path.exists(path):
        spark.sparkContext.addFile(path)
    goals = targets.select("mix_id", F.col("source").alias("spelled"), plain_name(F.col("source")).alias("source"), "target_weight", "max_repeat", "size_factor").collect()
    domains = sorted({g["source"] for g in goals if g["source"]})
    mixes = sorted({g["mix_id"] for g in goals})
    scratch = Scratch(spark, "mix")
    named = docs.select("doc_id", "text", plain_name(F.col("source")).alias("domain"))
    model = fit_classifier(named, domains, path)
    mass = scratch.keep(membership(named, domains, model, path), "mass")
    label = F.lit(-1)
    for k, domain in enumerate(domains):
        label = F.when(F.col("domain") == domain, F.lit(k)).otherwise(label)
    cells = scratch.keep(mass.groupBy("p", label.alias("label")).agg(F.sum("n_tokens").alias("tokens")), "cells")
    by_label = {r["label"]: int(r["n"]) for r in cells.groupBy("label").agg(F.sum("tokens").alias("n")).collect()}
    everything = sum(by_label.values())
    soft = np.zeros(len(domains))
    for r in cells.select(F.posexplode("p").alias("k", "x"), "tokens").groupBy("k").agg(F.sum(F.col("x") * F.col("tokens")).alias("x")).collect():
        soft[r["k"]] = r["x"]

    wanted, caps = np.zeros((len(mixes), len(domains))), np.zeros((len(mixes), len(domains)))
    for g in goals:
        if g["source"]:
            at = mixes.index(g["mix_id"]), domains.index(g["source"])
            wanted[at] += g["target_weight"] * g["size_factor"] * everything
            caps[at] = max(caps[at], g["max_repeat"])
    fit = fit_rates(cells, wanted, caps, soft)
    scratch.drop("cells")
    steps = fit.steps

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = np.array(b.column(1).to_pylist(), float).reshape(-1, len(domains))
            chance = b.column(2).to_numpy(zero_copy_only=False).astype(np.uint64)
            numbers = b.column(4).to_numpy(zero_copy_only=False)
            r, _ = steps.rates(p, numbers)
            for m, mix in enumerate(mixes):
                # Another uniform number for each mix, from the hash of the document.
                u = ((chance * np.uint64(2 * m + 1) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(float) / 2.0**53
                whole = np.floor(r[:, m])
                n = (whole + (u < r[:, m] - whole)).astype(np.int64)
                take = np.flatnonzero(n)
                at = pa.array(take)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([mix] * len(take), pa.int32()), b.column(0).take(at), b.column(4).take(at), b.column(3).take(at), pa.array(n[take])],
                    names=["mix_id", "doc_id", "label", "n_tokens", "copies"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    dice = F.xxhash64(F.lit(seed), "doc_id").alias("chance")
    drawn = mass.select("doc_id", "p", dice, "n_tokens", label.alias("label")).mapInArrow(draw, f"mix_id int, doc_id {kind}, label int, n_tokens long, copies long")
    copies = scratch.keep(drawn, "drawn")
    tokens = F.col("n_tokens") * F.col("copies")
    got = copies.groupBy("mix_id", "label").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.sum("copies").alias("copies"))
    size = got.groupBy("mix_id").agg(F.sum("tokens").alias("mix_tokens"))
    rows = []
    for g in goals:
        k, m = domains.index(g["source"]) if g["source"] else -2, mixes.index(g["mix_id"])
        target = float(g["target_weight"] * g["size_factor"] * everything)
        rows.append((int(g["mix_id"]), g["spelled"], k, float(g["target_weight"]), target, int(by_label.get(k, 0)), int(g["max_repeat"]), float(fit.got[m, k]) if k >= 0 else 0.0))
    labels = {m: {r[2] for r in rows if r[0] == m} for m in mixes}
    report = spark.createDataFrame(rows, "mix_id int, source string, label int, target_share double, target_tokens double, source_tokens bigint, max_repeat int, expected_tokens double")
    others = spark.createDataFrame([(int(m), k) for m in mixes for k in range(-1, len(domains)) if k not in labels[m]], "mix_id int, label int")
    figures = spark.createDataFrame([(int(m), float(fit.miss[k]), bool(fit.still[k])) for k, m in enumerate(mixes)], "mix_id int, missed double, settled boolean")
    rest = others.join(got, ["mix_id", "label"], "left").groupBy("mix_id").agg(F.sum("tokens").alias("tokens"), F.sum("copies").alias("copies"))
    blank = {"source": "string", "target_share": "double", "target_tokens": "double", "source_tokens": "bigint", "max_repeat": "int", "expected_tokens": "double"}
    every = report.join(got, ["mix_id", "label"], "left").drop("label").unionByName(rest.withColumns({c: F.lit(None).cast(t) for c, t in blank.items()}))
    tokens = F.coalesce("tokens", F.lit(0)).cast("bigint")
    short = (tokens >= F.col("max_repeat") * F.col("source_tokens")) & (tokens < F.col("target_tokens"))
    shares = (
        every.join(size, "mix_id", "left").join(figures, "mix_id")
        .select(
            "mix_id", *list(blank)[:5], tokens.alias("tokens"), F.coalesce("copies", F.lit(0)).cast("bigint").alias("copies"), "expected_tokens",
            F.coalesce(F.col("tokens") / F.nullif("mix_tokens", F.lit(0)), F.lit(0.0)).alias("actual_share"), F.coalesce(short, F.lit(False)).alias("short"), "missed", "settled",
        )
    )
    return Mix(shares, copies.select("mix_id", "doc_id", "copies", "n_tokens"))
