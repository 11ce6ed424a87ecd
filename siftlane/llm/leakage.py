"""Evaluation texts leaking into training texts, by spaced-seed hashing.

1. *Words.* Texts become words in a plain form (layout, letter forms and markup gone); a character of a script that is written
   without spaces is a word of its own. A word is a 32-bit number from there on.
2. *Seeds.* A spaced seed looks at the words of a window through a fixed mask that ignores some positions, so a changed word spoils only
   the windows that look at it. All seeds of the evaluation texts are a table ``hash, passage, place``; a seed that very many passages share
   tells nothing about one of them and is left to the alignment, unless a passage has too few others.
3. *One scan of the corpus* makes the same seeds. A bitmap of the test hashes, of bounded size, lets only documents through that share
   some; these leave their words, as numbers, and the hashes they share. The same scan counts in how many documents each three words in a
   row of the evaluation texts occur.
4. *Join* on the hash, and per document and passage a count of the shared seeds. Where they are at least ``HIT`` of the passage's, the two are
   aligned.
5. *Alignment* around the hits: a leak has at least ``SHARE`` of the passage's words in matching runs, in order, and ``INFORMED`` of its
   information: of each three words in a row, by how few documents of the corpus have them. Stock phrases and a frame with other fillings
   are found all over the corpus, and what ties a frame to its fillings is what they lack.

Nothing is collected on the driver but the bitmap and three numbers.
"""

from __future__ import annotations

import difflib
import html
import re
import unicodedata
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlane.session import Scratch

#: 1: a position that must agree, 0: one that is ignored.
MASKS = ((1, 1, 0, 1, 1, 1), (1, 0, 1, 1, 0, 1, 1), (1, 1, 1, 0, 0, 1, 0, 1))
#: Share of a passage's seeds that must be shared before the two are aligned: half a passage has half of them, and one changed word in eight
#: spoils no more than 70 % of these. Share of its words that must match; of its information, where a changed word spoils the three
#: runs that hold it: half of them, less one changed word in twenty.
HIT, SHARE, INFORMED = 0.15, 0.5, 0.425
#: Shortest matching run that counts, and by how many words of other text a copy may be interrupted in all.
RUN, SLACK = 3, 150
#: Passages with fewer words can't be told from stock phrases and short quotations; `too_short` lists them.
LEAST_WORDS = 12
#: A seed is common if more than this share of the passages have it, and at least so many.
COMMON, COMMON_LEAST = 0.02, 8
#: Bits of the bitmap: for each test hash, at least, and at most (32 MB; more hashes only let more through to the join).
BITS_PER_HASH, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 28

_INLINE = re.compile(r"</?(?:a|abbr|b|cite|code|em|font|i|mark|q|s|small|span|strong|sub|sup|tt|u)\b(?:[^<>]{0,200}|[^<>=]{0,80}=\s*[\"'][^<>]*)>", re.I)
_TAG = re.compile(r"<[/a-zA-Z!](?:[^<>]{0,200}|[^<>=]{0,80}=\s*[\"'][^<>]*)>")
_BREAK = re.compile("[-‐­][ \\t]*\\r?\\n[ \\t>|*#]*")
_ODD = re.compile(r"[^\x00-\x7e]{1,64}")
_NO_WORD = re.compile(r"(?:[^\w\s]|_)+")
#: Letters of scripts without spaces between words: Thai to Burmese, Khmer, kana, Han.
_UNSPACED = re.compile("([฀-໿က-႟ក-៿぀-ヿ㐀-䶿一-鿿豈-﫿\U00020000-\U0003134f])")
# Letters that compatibility decomposition leaves whole, and dashes that part words.
_LETTERS = str.maketrans({"œ": "oe", "æ": "ae", "ø": "o", "ł": "l", "đ": "d", "ı": "i", "—": " ", "–": " "})


@lru_cache(maxsize=1 << 14)
def _plain_form(chars: str) -> str:
    whole = unicodedata.normalize("NFKD", chars.translate(_LETTERS))
    return "".join(c for c in whole if c < "\x7f" or not (unicodedata.combining(c) or unicodedata.category(c) == "Cf"))


def _plainer(hit: re.Match) -> str:
    return _plain_form(hit.group())


def plain_words(text: str | None) -> list[str]:
    """The words of a text: no markup, no words broken at line ends, no accents, case, ligatures, invisible or punctuation characters."""
    if not text:
        return []
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", _INLINE.sub("", text))
    text = _BREAK.sub("", text)
    if not text.isascii():
        # Sequence by sequence, of which there are few different ones.
        text = _ODD.sub(_plainer, text)
        text = _UNSPACED.sub(r" \1 ", text)
    return _NO_WORD.sub("", text).casefold().split()


class _Numbers(dict):
    """The number of each word, the same on every task."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        self[word] = number = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        return number


def _numbered(texts: Sequence[str | None], numbers: _Numbers) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts in a row, and the row's length after each text."""
    lists = [plain_words(t) for t in texts]
    ends = np.cumsum([len(x) for x in lists], dtype=np.int64)
    return np.fromiter((numbers[w] for x in lists for w in x), np.uint32, int(ends[-1]) if len(ends) else 0), ends


def _seeds(words: np.ndarray, owner: np.ndarray, mask: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows that lie within one text, and where they start."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = np.full(n, int("".join(map(str, mask)), 2) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF, np.uint64)
    for k, look in enumerate(mask):
        if look:
            value = (value ^ words[k : k + n]) * np.uint64(0xBF58476D1CE4E5B9)
            value ^= value >> np.uint64(29)
    at = np.flatnonzero(owner[:n] == owner[len(mask) - 1 :])
    return value[at], at


_THREE = (1,) * RUN


def _all_seeds(words: np.ndarray, owner: np.ndarray, masks: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    parts = [_seeds(words, owner, m) for m in masks]
    return np.concatenate([v for v, _ in parts]), np.concatenate([a for _, a in parts])


class Bitmap:
    """Two bits for each hash; what isn't set in both was never put in."""

    def __init__(self, words: np.ndarray) -> None:
        self.words, self.mask = words, np.uint64(len(words) * 64 - 1)

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        good = np.ones(len(hashes), bool)
        for shift in (np.uint64(0), np.uint64(32)):
            bit = (hashes >> shift) & self.mask
            good &= ((self.words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1)).astype(bool)
        return good


def _bitmap(hashes: DataFrame, count: int) -> np.ndarray:
    bits = LEAST_BITS
    while bits < min(MOST_BITS, count * BITS_PER_HASH):
        bits *= 2
    low = [c.bitwiseAND(F.lit(bits - 1)) for c in (F.col("hash"), F.shiftrightunsigned("hash", 32))]
    flat = hashes.select(F.explode(F.array(*low)).alias("bit"))
    rows = flat.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, CAST(bit & 63 AS INT)))").alias("v"))
    out = np.zeros(bits // 64, np.int64)
    got = rows.toPandas()
    out[got["word"].to_numpy(dtype=np.int64)] = got["v"].to_numpy(dtype=np.int64)
    return out.view(np.uint64)


def too_short(passages: DataFrame, passage_id: str = "passage_id", text: str = "text") -> DataFrame:
    """``passage_id, words`` of the passages that have too few words to be judged (NULL and empty ones have 0)."""
    scratch = Scratch(passages.sparkSession, "short")
    return scratch.keep(_passage_words(passages, passage_id, text), "words").select("passage_id", "n").where(F.col("n") < LEAST_WORDS).withColumnRenamed("n", "words")


def _passage_words(passages: DataFrame, passage_id: str, text: str) -> DataFrame:
    """``passage_id, w, n``: words of a passage as little-endian 32-bit numbers, and how many."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _Numbers()
        for b in batches:
            lists = [np.fromiter((numbers[w] for w in plain_words(t)), np.uint32) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in lists], pa.binary()), pa.array([len(x) for x in lists], pa.int32())], names=["passage_id", "w", "n"])

    kind = passages.schema[passage_id].dataType.simpleString()
    return passages.where(F.col(passage_id).isNotNull()).select(passage_id, text).mapInArrow(words, f"passage_id {kind}, w binary, n int")


def _passage_seeds(texts: DataFrame) -> DataFrame:
    """``p, hash, place, three`` for every seed of every different passage; ``three`` marks the runs of three words."""

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, w in enumerate(b.column(1).to_pylist()):
                words = np.frombuffer(w, np.uint32)
                owner = np.zeros(len(words), np.int8)
                for three, masks in ((False, MASKS), (True, (_THREE,))):
                    value, at = _all_seeds(words, owner, masks)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array([k] * len(value), pa.int64())), pa.array(value.view(np.int64)), pa.array(at.astype(np.int32)), pa.array(np.full(len(value), three))], names=["p", "hash", "place", "three"]
                    )

    kind = texts.schema["p"].dataType.simpleString()
    return texts.select("p", "w").mapInArrow(seeds, f"p {kind}, hash long, place int, three boolean")


def _windows(lines: np.ndarray, size: int, length: int) -> list[tuple[int, int]]:
    """The stretches of a document around the densest diagonals that hold enough matching words together to reach the share, densest first. A
    copy may be interrupted; every diagonal is in one stretch, and there may be any number of these."""
    out: list[tuple[int, int]] = []
    rest = np.sort(lines)
    while len(rest):
        near = np.searchsorted(rest, rest + SLACK, "right") - np.arange(len(rest))
        k = int(near.argmax())
        # A run of r words has r - RUN + 1 hits, so SHARE of the words in runs of RUN has a third of these hits.
        if near[k] * RUN < SHARE * size:
            break
        low, high = int(rest[k]), int(rest[k + near[k] - 1])
        out.append((max(0, low - RUN), min(length, high + size + RUN)))
        rest = rest[(rest < low) | (rest > high)]
    return out


def alignment(words: np.ndarray, weight: np.ndarray, doc: np.ndarray) -> tuple[float, float]:
    """Shares of a passage's words and of its information that a document holds in matching runs, in order, at its best place; ``weight``: the
    information of the run of three words that begins at each word."""
    mine, at = _seeds(words, np.zeros(len(words), np.int8), _THREE)
    theirs, where = _seeds(doc, np.zeros(len(doc), np.int8), _THREE)
    order = np.argsort(mine, kind="stable")
    mine, at = mine[order], at[order]
    low, high = np.searchsorted(mine, theirs, "left"), np.searchsorted(mine, theirs, "right")
    n = high - low
    entry = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    lines = np.repeat(where, n) - at[entry]
    listed, total, best = words.tolist(), float(weight.sum()), (0.0, 0.0)
    for a, b in _windows(lines, len(words), len(doc)):
        blocks = difflib.SequenceMatcher(None, listed, doc[a:b].tolist(), autojunk=False).get_matching_blocks()
        runs = [(x.a, x.a + x.size) for x in blocks if x.size >= RUN]
        got = sum(y - x for x, y in runs) / len(words), sum(float(weight[x : y - RUN + 1].sum()) for x, y in runs) / total
        best = max(best, got, key=lambda g: min(g[0] / SHARE, g[1] / INFORMED))
    return best


def find_leaks(spark: SparkSession, docs: DataFrame, passages: DataFrame, doc_id: str = "doc_id", passage_id: str = "passage_id", text: str = "text") -> DataFrame:
    """``doc_id, passage_id, share``: every document that holds at least half of a passage, with the share of its words found.

    Whole texts of any length are searched. NULL and empty texts hold nothing and, like passages of fewer than
    ``LEAST_WORDS`` words (see `too_short`), leak nothing. Repeated documents are found each (``doc_id`` must be unique); a passage given twice is
    found under both ids. An empty side gives an empty result. The result doesn't depend on how either side is partitioned.
    """
    scratch = Scratch(spark, "leaks")
    doc_kind = docs.schema[doc_id].dataType.simpleString()
    named = scratch.keep(_passage_words(passages, passage_id, text).where(F.col("n") >= LEAST_WORDS), "passages")
    # Equal passages are one for all that follows, by the smallest id.
    texts = scratch.keep(named.groupBy("w", "n").agg(F.min("passage_id").alias("p")), "texts")
    seeds = scratch.keep(_passage_seeds(texts), "seeds")
    total = texts.count()
    if not total:
        return spark.createDataFrame([], f"doc_id {doc_kind}, passage_id {passages.schema[passage_id].dataType.simpleString()}, share double")

    # Seeds for the join: the rare ones; all of them for a passage of which less than half are rare.
    spaced = seeds.where("NOT three").select("p", "hash").distinct()
    spread = spaced.groupBy("hash").agg(F.count("*").alias("df"))
    ranked = spaced.join(spread, "hash").withColumn("rare", F.col("df") <= F.lit(max(COMMON_LEAST, COMMON * total)))
    rare = ranked.groupBy("p").agg(F.count_if(F.col("rare")).alias("rares"), F.count("*").alias("all"))
    enough = rare.withColumn("enough", F.col("rares") >= F.col("all") / 2).select("p", "enough")
    wanted = scratch.keep(ranked.join(enough, "p").where("rare OR NOT enough").select("p", "hash"), "wanted")
    needs = scratch.keep(wanted.groupBy("p").agg((F.count("*") * F.lit(HIT)).alias("need")), "needs")
    least = needs.agg(F.min("need")).first()[0]
    least_hits = max(1, int(np.ceil(float(least or 0))))
    threes = seeds.where("three").select("hash").distinct()
    hashes = wanted.select("hash").unionByName(threes).distinct()
    shared = spark.sparkContext.broadcast(_bitmap(hashes, hashes.count()))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, known = _Numbers(), Bitmap(shared.value)
        for b in batches:
            words, ends = _numbered(b.column(1).to_pylist(), numbers)
            owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
            value, at = _all_seeds(words, owner, MASKS)
            hit = known.may_hold(value)
            value, whose = value[hit], owner[at[hit]]
            order = np.argsort(whose, kind="stable")
            value, whose = value[order], whose[order]
            first, last = np.searchsorted(whose, np.arange(len(ends)), "left"), np.searchsorted(whose, np.arange(len(ends)), "right")
            take = np.flatnonzero(last - first >= least_hits)
            found = [np.unique(value[first[k] : last[k]]).view(np.int64) for k in take]
            three, at = _seeds(words, owner, _THREE)
            hit = known.may_hold(three)
            three, whose = three[hit], owner[at[hit]]
            order = np.lexsort((three, whose))
            three, whose = three[order], whose[order]
            fresh = np.append(True, (three[1:] != three[:-1]) | (whose[1:] != whose[:-1])) if len(three) else np.zeros(0, bool)
            runs, n = np.unique(three[fresh], return_counts=True)
            rest = len(runs) + 1
            blank = pa.nulls(rest)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([b.column(0).take(pa.array(take)), blank.cast(b.column(0).type)]),
                    pa.array([*[words[ends[k - 1] if k else 0 : ends[k]].tobytes() for k in take], *[None] * rest], pa.binary()),
                    pa.array([*found, *[None] * rest], pa.list_(pa.int64())),
                    pa.array([*[None] * len(take), *runs.view(np.int64).tolist(), None], pa.int64()),
                    pa.array([*[None] * len(take), *n.tolist(), len(ends)], pa.int64()),
                    pa.array([*["docs"] * len(take), *["counts"] * rest], pa.string()),
                ],
                names=["doc_id", "words", "seeds", "hash", "n", "kind"],
            )

    scanned = scratch.keep(docs.select(doc_id, text).mapInArrow(scan, f"doc_id {doc_kind}, words binary, seeds array<long>, hash long, n long, kind string"), "scan", partition_by="kind")
    near = scanned.where("kind = 'docs'").select("doc_id", "words", "seeds")
    counts = scanned.where("kind = 'counts'").groupBy("hash").agg(F.sum("n").alias("n"))
    all_docs = counts.where("hash IS NULL").agg(F.sum("n")).first()[0] or 0

    # The information of each run of three words, by how common it is in the corpus.
    idf = F.log((F.lit(all_docs) + 1.0) / (F.coalesce("n", F.lit(0)) + 1.0)) + 0.05
    informed = seeds.where("three").select("p", "hash", "place").join(counts.where("hash IS NOT NULL"), "hash", "left").select("p", "place", idf.alias("idf"))
    weights = informed.groupBy("p").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "idf"))), lambda x: x["idf"]).alias("idf"))

    hits = near.select("doc_id", F.explode("seeds").alias("hash")).join(wanted, "hash")
    pairs = hits.groupBy("doc_id", "p").agg(F.count("*").alias("n")).join(needs, "p").where(F.col("n") >= F.col("need"))
    cases = pairs.select("doc_id", "p").join(near.select("doc_id", "words"), "doc_id").join(texts.join(weights, "p"), "p")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, shares = [], []
            for k, (w, words, idf) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4), strict=True)):
                share, information = alignment(np.frombuffer(w, np.uint32), idf.values.to_numpy(zero_copy_only=False), np.frombuffer(words, np.uint32))
                if share >= SHARE and information >= INFORMED:
                    kept.append(k)
                    shares.append(round(share, 4))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(kept, pa.int64())), b.column(1).take(pa.array(kept, pa.int64())), pa.array(shares, pa.float64())], names=["doc_id", "p", "share"])

    id_kind = passages.schema[passage_id].dataType.simpleString()
    leaks = cases.select("doc_id", "p", "w", "words", "idf").mapInArrow(align, f"doc_id {doc_kind}, p {id_kind}, share double")
    same = texts.join(named, ["w", "n"]).select("p", "passage_id")
    return leaks.join(same, "p").select("doc_id", "passage_id", "share")
