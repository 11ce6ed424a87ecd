"""Texts garbled by a wrong character encoding: found, and restored where nothing was lost.

1. *Counts.* One pass counts adjacent character pairs over all texts, and words with a non-ASCII character.
2. *Reference.* A large corpus holds the same garbling many times over, and mutual information, which doesn't depend on how often
   something occurs, would tie the garbled characters to one another. So words that are garbled by themselves are taken out
   of the pair counts: those that hold UTF-8 sequences read as one-byte characters (and give pairs that the corpus has), those with
   replacement characters that aren't quoted, and those that a one-byte inverse mapping turns into a word more common by ``PRIOR`` bits, twice that
   for words of one character (the table of words joined with itself).
3. *Mutual information* of a pair: log2 of how often it occurs over how often it would if its characters were independent. For rare pairs
   it is drawn towards that of their classes (category and script), by ``SHRINK`` occurrences: a symbol that never stood inside a word
   tells by its class that it doesn't belong there. A character that only occurs in words taken out has ``FOREIGN`` bits with any other.
   Neither the frequency of a character nor that of a script moves it.
4. *Runs.* ``level`` (a share of the mean mutual information of the corpus) minus the mutual information of a pair is its score; pairs
   of two ASCII characters count against a run. The maximum-scoring segments (Ruzzo and Tompa's linear algorithm) are the
   improbable runs. They are widened to whole sequences of non-ASCII characters.
5. *Inverse mappings*, only inside runs. UTF-8 read as a one-byte encoding is undone where the bytes are valid UTF-8 again and
   give attested pairs, repeatedly until nothing changes. A one-byte encoding read as another always maps back, so there the words decide: a
   stretch of words that holds a run is put back if its words become more common by ``GAIN`` bits together. A bitmap of bounded size knows the words that
   some mapping makes more common; texts with such a word in a run have their words joined with the table of all words, which is never
   collected. Characters lost for good are reported as such.

Texts are read whole; a text without an improbable run leaves the batch it is read in.
"""

from __future__ import annotations

import re
import string
import unicodedata
import zlib
from collections import Counter
from collections.abc import Callable, Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlane.session import Scratch

#: Occurrences by which a pair is drawn to its classes; share of the mean mutual information under which a pair counts for a run.
SHRINK, LEVEL = 5.0, 0.5
#: Mutual information of a character that the reference lacks with any other.
FOREIGN = -4.0
#: Pairs of two classes that make up less than this share of all pairs of these classes are judged by the classes alone; so
#: the table that is broadcast has at most 1/EPSILON rows for each two classes, whatever the corpus, and no script crowds out another.
EPSILON = 1e-5
#: Bits a run must score to be looked at; bits by which each restored word must be more common to count for a confusion, and what a
#: stretch must score beyond that.
RUN, PRIOR, GAIN = 1.0, 3.0, 3.0
#: Share of the restored pairs that the corpus must know.
ATTESTED = 0.8
LOST = "�"
#: A replacement character that stands for one lost: not one that is quoted, between punctuation marks on both sides.
_LOSS = re.compile("(?:(?<![!-/:-@\\[-`{-~‘-‟«»])�|�(?![!-/:-@\\[-`{-~‘-‟«»]))")

# Names of encodings. UTF-8 has been read as one of the first; one of TRUE has been read as one of WRONG.
READ_AS = ("cp1252", "latin_1", "mac_roman", "cp437", "cp850", "cp1251", "cp1250", "iso8859_2", "koi8_r", "cp866", "iso8859_15", "cp1254")
TRUE = ("cp1252", "cp1251", "cp1250", "iso8859_2", "mac_roman", "koi8_r", "cp850", "cp437", "cp866")
WRONG = ("cp1252", "latin_1", "mac_roman", "cp437", "cp850", "cp1251", "cp1250", "koi8_r", "cp866")
CONFUSIONS = [(t, w) for t in TRUE for w in WRONG if t != w]

_ODD = re.compile(r"[^\x00-\x7f]+")
#: Scripts without spaces between words (Thai to Burmese, Khmer, kana, Han) have no words here; their pairs are counted all the same.
_UNSPACED = "฀-໿က-႟ក-៿぀-ヿ㐀-䶿一-鿿豈-﫿\U00020000-\U0003134f"
_WORD = re.compile(rf"[^\x00-\x20{_UNSPACED}]*[^\x00-\x7f{_UNSPACED}][^\x00-\x20{_UNSPACED}]*")
_EDGE = string.punctuation + string.digits
_BASE = 1 << 21
#: Characters counted at once.
CHUNK = 1 << 20
#: Bits of the bitmap of words: for each word, at least, and at most (32 MB; more words only let more texts through to the join).
BITS_PER_WORD, LEAST_BITS, MOST_BITS = 64, 1 << 16, 1 << 28


def _codes(texts: list[str]) -> np.ndarray:
    """Code points of all texts, each text between line ends; digits are one character, white space is another."""
    joined = "\n" + "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    codes[(codes >= 48) & (codes <= 57)] = 48
    codes[(codes == 9) | (codes == 10) | (codes == 13) | (codes == 160) | (codes == 8239)] = 32
    return codes


def _count_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of all texts and their counts, taken ``CHUNK`` characters at a time; a piece of a longer text begins with the last
    character of the one before, so no pair is lost or added."""
    parts: list[np.ndarray] = []
    sums: list[np.ndarray] = []

    def add(codes: np.ndarray) -> None:
        pairs, n = np.unique(codes[:-1] * _BASE + codes[1:], return_counts=True)
        parts.append(pairs)
        sums.append(n)

    held: list[str] = []
    size = 0
    for t in texts:
        if len(t) > CHUNK:
            line = _codes([""])[:1]
            add(np.concatenate([line, _codes([t[0]])[1:2]]))
            for k in range(0, len(t) - 1, CHUNK):
                add(_codes([t[k : k + CHUNK + 1]])[1:-1])
            add(np.concatenate([_codes([t[-1]])[1:2], line]))
            continue
        held.append(t)
        size += len(t)
        if size >= CHUNK:
            add(_codes(held))
            held, size = [], 0
    if held:
        add(_codes(held))
    return _added(np.concatenate(parts), np.concatenate(sums))


def _added(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(keys, return_inverse=True)
    return found, np.bincount(at, n, len(found)).astype(np.int64)


def odd_words(text: str) -> Iterator[tuple[int, int]]:
    """Where the words with a non-ASCII character are, without ASCII punctuation and digits at their ends."""
    for hit in _WORD.finditer(text):
        word = hit.group()
        a = hit.start() + len(word) - len(word.lstrip(_EDGE))
        yield a, hit.end() - len(word) + len(word.rstrip(_EDGE))


def count_pairs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``pair, word, n`` over all texts: a pair is ``first * 2**21 + second``, a row counts a pair or a word; a word has the characters on its two
    sides with it. NULL texts count nothing."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t for t in batch.column(0).to_pylist() if t]
            if not texts:
                continue
            pairs, n = _count_codes(texts)
            # Padded, so that a word at either end of a text has a neighbour too.
            words = Counter(t[a - 1 : b + 1] for t in (f"\n{t}\n" for t in texts if not t.isascii()) for a, b in odd_words(t))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*pairs.tolist(), *[None] * len(words)], pa.int64()),
                    pa.array([*[None] * len(pairs), *words], pa.string()),
                    pa.array([*n.tolist(), *words.values()], pa.int64()),
                ],
                names=["pair", "word", "n"],
            )

    return docs.select(text).mapInArrow(count, "pair long, word string, n long").groupBy("pair", "word").agg(F.sum("n").alias("n"))


@lru_cache(maxsize=1 << 16)
def char_class(code: int) -> int:
    """Category and, for letters, script of a character, as one number below 1024."""
    char = chr(code)
    kind = unicodedata.category(char) if code < 0xD800 or code > 0xDFFF else "Cs"
    group = 0
    if kind[0] in "LM":
        group = 0 if code < 128 else 1 if code < 0x250 or 0x1E00 <= code < 0x1F00 else 2 if code < 0x400 else 3 if code < 0x530 else 4 if code < 0x2E80 else 5
    return ("LMNPSZC".index(kind[0]) * 16 + "ulmtodcefnipskhgajbqrvwxyz".index(kind[1]) % 16) * 6 + group


class PairModel:
    """Mutual information of adjacent characters, and what follows from it.

    pairs, counts: the reference counts that are kept; first, second: each character (sorted) with how often it comes first and second in
    a pair; cells: the counts of two classes, as ``class * 1024 + class``.
    """

    def __init__(self, pairs: np.ndarray, counts: np.ndarray, first: tuple[np.ndarray, np.ndarray], second: tuple[np.ndarray, np.ndarray], cells: tuple[np.ndarray, np.ndarray]) -> None:
        order = np.argsort(pairs)
        self.pairs, self.n = pairs[order], counts[order].astype(float)
        self.known = set(pairs.tolist())
        self.first, self.second = first, second
        self.total = max(1.0, float(first[1].sum()))
        self.cells = dict(zip(cells[0].tolist(), cells[1].astype(float).tolist(), strict=True))
        self.class_first, self.class_second = Counter(), Counter()
        for cell, n in self.cells.items():
            self.class_first[cell >> 10] += n
            self.class_second[cell & 1023] += n
        self.ratios: dict[int, float] = {}
        self.memo: dict[int, float] = {}
        self.pmi = self._information(self.pairs, self.n)
        odd = (self.pairs // _BASE > 127) | (self.pairs % _BASE > 127)
        mean = float((self.n * self.pmi)[odd].sum() / max(1.0, self.n[odd].sum()))
        #: A corpus without dependence between characters has no level to speak of.
        self.level = LEVEL * max(mean, 0.5)

    @classmethod
    def of(cls, pairs: np.ndarray, counts: np.ndarray) -> PairModel:
        """From complete counts."""
        classes = [np.array([char_class(c) for c in side.tolist()], np.int64) for side in (pairs // _BASE, pairs % _BASE)]
        return cls(pairs, counts, _added(pairs // _BASE, counts), _added(pairs % _BASE, counts), _added(classes[0] * 1024 + classes[1], counts))

    def _ratio(self, cell: int) -> float:
        """How much more often two classes meet than they would if they were independent."""
        if cell not in self.ratios:
            expected = self.class_first[cell >> 10] * self.class_second[cell & 1023] / self.total
            self.ratios[cell] = (self.cells.get(cell, 0.0) + 1) / (expected + 1)
        return self.ratios[cell]

    @staticmethod
    def _among(table: tuple[np.ndarray, np.ndarray], codes: np.ndarray) -> np.ndarray:
        if not len(table[0]):
            return np.zeros(len(codes))
        spot = np.minimum(np.searchsorted(table[0], codes), len(table[0]) - 1)
        return np.where(table[0][spot] == codes, table[1][spot], 0).astype(float)

    def _information(self, pairs: np.ndarray, n: np.ndarray) -> np.ndarray:
        x, y = pairs // _BASE, pairs % _BASE
        if not len(pairs):
            return np.zeros(0)
        expected = self._among(self.first, x) * self._among(self.second, y) / self.total
        foreign = self._foreign(x) | self._foreign(y)
        ratio = np.array([self._ratio(char_class(a) * 1024 + char_class(b)) for a, b in zip(x.tolist(), y.tolist(), strict=True)])
        return np.where(foreign, FOREIGN, np.log2((n + SHRINK * ratio) / (expected + SHRINK)))

    def _foreign(self, codes: np.ndarray) -> np.ndarray:
        return (self._among(self.first, codes) == 0) & (self._among(self.second, codes) == 0)

    def information(self, pairs: np.ndarray) -> np.ndarray:
        """The mutual information of pairs, known or not."""
        if not len(self.pairs):
            return np.zeros(len(pairs))
        spot = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        out, new = self.pmi[spot], np.flatnonzero(self.pairs[spot] != pairs)
        if len(new):
            kinds, at = np.unique(pairs[new], return_inverse=True)
            out[new] = self._information(kinds, np.zeros(len(kinds)))[at]
        return out

    def scores(self, codes: np.ndarray) -> np.ndarray:
        """The score of each character with the one before it."""
        out = np.full(len(codes) - 1, -self.level)
        odd = np.flatnonzero((codes[:-1] > 127) | (codes[1:] > 127))
        out[odd] = self.level - self.information(codes[odd] * _BASE + codes[odd + 1])
        return out

    def _one(self, x: int, y: int) -> float:
        pair = x * _BASE + y
        if pair not in self.memo:
            if len(self.memo) > 500_000:
                self.memo.clear()
            self.memo[pair] = float(self.information(np.array([pair]))[0])
        return self.memo[pair]

    def short_score(self, text: str) -> float:
        """The summed score of the pairs within a short text."""
        codes = [_plain(c) for c in text]
        return sum(self.level - self._one(x, y) for x, y in zip(codes, codes[1:], strict=False) if x > 127 or y > 127)

    def knows(self, text: str) -> bool:
        return not self._foreign(np.array([_plain(c) for c in text], np.int64)).any()

    def attested(self, text: str) -> float:
        """The share of the pairs with a non-ASCII character that the reference holds, or that it doesn't part."""
        codes = [_plain(c) for c in text]
        odd = [x * _BASE + y in self.known or self._one(x, y) > -1.0 for x, y in zip(codes, codes[1:], strict=False) if x > 127 or y > 127]
        return sum(odd) / len(odd) if odd else 1.0


def _plain(char: str) -> int:
    code = ord(char)
    if 48 <= code <= 57:
        return 48
    return 32 if code in (9, 10, 13, 160, 8239) else code


def maximal_segments(scores: np.ndarray, least: float) -> list[tuple[int, int]]:
    """All maximal scoring segments [start, end) with a score of at least ``least``."""
    if not len(scores):
        return []
    sign = scores > 0
    edges = np.flatnonzero(np.diff(sign)) + 1
    bounds = np.concatenate([[0], edges, [len(scores)]])
    sums = np.add.reduceat(scores, bounds[:-1])
    stack: list[list[float]] = []  # start, end, sum before, sum at the end
    run = 0.0
    for k, s in enumerate(sums):
        before, run = run, run + s
        if s <= 0:
            continue
        seg = [bounds[k], bounds[k + 1], before, run]
        while stack:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= seg[2]:
                j -= 1
            if j < 0 or stack[j][3] >= seg[3]:
                break
            seg = [stack[j][0], seg[1], stack[j][2], seg[3]]
            del stack[j:]
        stack.append(seg)
    return [(int(a), int(b)) for a, b, low, high in stack if high - low >= least]


def improbable_runs(text: str, model: PairModel, scores: np.ndarray | None = None) -> list[tuple[int, int]]:
    """The runs of a text, as slices; each holds whole sequences of non-ASCII characters."""
    runs: list[tuple[int, int]] = []
    if scores is None:
        scores = model.scores(_codes([text])[:-1])
    for a, b in maximal_segments(scores, RUN):
        a, b = max(0, a - 1), min(len(text), b)
        while a > 0 and text[a - 1] > "\x7f":
            a -= 1
        while b < len(text) and text[b] > "\x7f":
            b += 1
        if runs and a <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(b, runs[-1][1]))
        else:
            runs.append((a, b))
    return runs


@lru_cache(maxsize=64)
def _to_bytes(codec: str) -> dict[str, int]:
    """Byte of each character; bytes the encoding leaves undefined stand for the control of the same number."""
    out = {}
    for byte in range(128, 256):
        try:
            out[bytes([byte]).decode(codec)] = byte
        except UnicodeDecodeError:
            out[chr(byte)] = byte
    for byte in range(128, 160):
        out.setdefault(chr(byte), byte)
    return out


_UTF8 = re.compile(rb"(?:[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3})+")


def undo_utf8(run: str, codec: str, accept: Callable[[str, str], bool] | None = None) -> tuple[str, int]:
    """The run with every valid UTF-8 sequence put back that ``accept(what it gives, the same with its neighbours)`` takes, and
    how many characters came of it."""
    table = _to_bytes(codec)
    out, last, found = [], 0, 0
    for span in _ODD.finditer(run):
        chars = span.group()
        if len(chars) < 2:
            continue
        # Characters that the encoding lacks can't be bytes of it.
        raw = bytes([table.get(c, 0x01) for c in chars])
        for hit in _UTF8.finditer(raw):
            try:
                good = hit.group().decode("utf-8")
            except UnicodeDecodeError:
                continue
            a, b = span.start() + hit.start(), span.start() + hit.end()
            if accept is None or accept(good, run[max(0, a - 1) : a] + good + run[b : b + 1]):
                out += [run[last:a], good]
                last, found = b, found + len(good)
    return "".join([*out, run[last:]]), found


@lru_cache(maxsize=256)
def _table(true: str, wrong: str) -> dict[int, str]:
    """Translation that undoes reading ``true`` as ``wrong``."""
    out = {}
    for char, byte in _to_bytes(wrong).items():
        try:
            right = bytes([byte]).decode(true)
        except UnicodeDecodeError:
            continue
        if right != char:
            out[ord(char)] = right
    return out


def _around(text: str, a: int, b: int, run: str) -> str:
    return text[max(0, a - 1) : a] + run + text[b : b + 1]


_TWO = re.compile(r"[^\x00-\x7f]{2}")


def _undo_utf8_in_runs(text: str, runs: list[tuple[int, int]], model: PairModel) -> tuple[str, str] | None:
    best: tuple[float, str, str] | None = None
    # A sequence has two bytes at least.
    runs = [(a, b) for a, b in runs if _TWO.search(text, a, b)]
    if not runs:
        return None
    for codec in READ_AS:

        def accept(good: str, around: str, codec: str = codec) -> bool:
            # Three bytes hardly ever form a sequence by chance: that the characters are known is enough. Twice garbled text is attested only
            # after the second step.
            return model.attested(around) >= ATTESTED or (min(good) >= "\u0800" and model.knows(good)) or undo_utf8(good, codec)[1] > 0

        new, saved, last = [], 0.0, 0
        for a, b in runs:
            whole = _around(text, a, b, text[a:b])
            fixed, found = undo_utf8(whole, codec, accept)
            gain = model.short_score(whole) - model.short_score(fixed) if found else 0.0
            if gain > 0:
                left, right = len(text[max(0, a - 1) : a]), len(text[b : b + 1])
                new += [text[last:a], fixed[left : len(fixed) - right]]
                last, saved = b, saved + gain
        if new and (best is None or saved > best[0] + 1e-9):
            best = (saved, codec, "".join([*new, text[last:]]))
    return (best[2], f"utf-8 as {best[1]}") if best else None


def undo_utf8_steps(text: str, runs: list[tuple[int, int]], model: PairModel) -> tuple[str, list[str], list[tuple[int, int]]]:
    """The text with all UTF-8 steps undone, what they were, and the runs that are left. Every step makes the text shorter, so this ends."""
    undone: list[str] = []
    while runs:
        step = _undo_utf8_in_runs(text, runs, model)
        if step is None or len(step[0]) >= len(text):
            break
        text = step[0]
        undone.append(step[1])
        runs = improbable_runs(text, model)
    return text, undone, runs


def _sound(word: str) -> bool:
    """Whether a word may be right: letters of one script, no controls, no graphic characters."""
    scripts = set()
    for c in word:
        if c > "\x7f" or c.isalpha():
            kind = unicodedata.category(c)
            if kind[0] == "C" or kind == "Sk" or "─" <= c <= "◿":
                return False
            if kind[0] == "L":
                scripts.add(3 if "Ѐ" <= c <= "ԯ" else 2 if "Ͱ" <= c <= "Ͽ" else 1)
    return len(scripts) < 2


def _inverses(word: str) -> Iterator[tuple[int, str]]:
    """What each one-byte confusion would make of a word, where that may be right."""
    for k, (true, wrong) in enumerate(CONFUSIONS):
        fixed = word.translate(_table(true, wrong))
        if fixed != word and _sound(fixed):
            yield k, fixed


#: For a word its count, and for each confusion that gives a known word that word and its count.
Options = Mapping[str, tuple[int, Mapping[int, tuple[str, int]]]]


def options_of(words: Mapping[str, int]) -> dict[str, tuple[int, dict[int, tuple[str, int]]]]:
    """The options of all words of a table in memory."""
    return {w: (n, {k: (fixed, words[fixed]) for k, fixed in _inverses(w) if fixed in words}) for w, n in words.items()}


def _undo_confusion(text: str, runs: list[tuple[int, int]], options: Options) -> tuple[str, str] | None:
    """Undo the confusion that makes a stretch of words most common; the stretch holds an improbable run."""
    words = [(a, b, *options.get(text[a:b], (0, {}))) for a, b in odd_words(text)]
    inside = [any(a < y and x < b for x, y in runs) for a, b, _, _ in words]
    bits = lambda n, m: float(np.log2((m + 0.5) / (n + 0.5)))
    best: tuple[float, int, int, int] | None = None
    for k in sorted({k for (_, _, n, o), run in zip(words, inside, strict=True) if run for k, (_, m) in o.items() if m > n}):
        table = _table(*CONFUSIONS[k])
        gains = np.array([bits(n, o[k][1]) - PRIOR if k in o else bits(n, 0) - PRIOR if text[a:b].translate(table) != text[a:b] else 0.0 for a, b, n, o in words])
        for a, b in maximal_segments(gains, GAIN):
            total = float(gains[a:b].sum())
            if any(inside[a:b]) and (best is None or total > best[0] + 1e-9):
                best = (total, k, a, b)
    if best is None:
        return None
    _, k, start, end = best
    new, last = [], 0
    for a, b, _, o in words[start:end]:
        if k in o:
            new += [text[last:a], o[k][0]]
            last = b
    true, wrong = CONFUSIONS[k]
    return "".join([*new, text[last:]]), f"{true} as {wrong}"


def undo_confusions(text: str, runs: list[tuple[int, int]], model: PairModel, options: Options) -> tuple[str, list[str]]:
    """The text with all one-byte confusions undone. Each step makes its words more common by at least GAIN bits, so this ends."""
    undone: list[str] = []
    while runs:
        step = _undo_confusion(text, runs, options)
        if step is None:
            break
        text = step[0]
        undone.append(step[1])
        runs = improbable_runs(text, model)
    return text, undone


def is_lost(text: str, runs: list[tuple[int, int]]) -> bool:
    return LOST in text and any(_LOSS.search(text, max(0, a - 1), b + 1) for a, b in runs)


def restore(text: str, model: PairModel, options: Options | None = None) -> tuple[str | None, str | None]:
    """(restored text, what was undone) of a garbled text, (None, None) of a clean one, (None, 'lost') where characters were
    lost for good. What `find_garbled` does to each text, for a table of words in memory."""
    runs = improbable_runs(text, model) if not text.isascii() else []
    if is_lost(text, runs):
        return None, "lost"
    text, undone, runs = undo_utf8_steps(text, runs, model)
    text, more = undo_confusions(text, runs, model, options or {})
    return (text, "; ".join(undone + more)) if undone or more else (None, None)


def _damaged(word: str, known: set[int], chars: set[int]) -> bool:
    """Whether a word is garbled by itself: it holds UTF-8 sequences that give pairs of ``known`` or, of three bytes and more, known characters; or
    characters were lost in it."""
    if LOST in word and (len(word) == 1 or _LOSS.search(word)):
        return True

    def accept(good: str, around: str, codec: str) -> bool:
        codes = [_plain(c) for c in around]
        odd = [x * _BASE + y in known for x, y in zip(codes, codes[1:], strict=False) if x > 127 or y > 127]
        return sum(odd) >= ATTESTED * len(odd) or (min(good) >= "\u0800" and all(_plain(c) in chars for c in good)) or undo_utf8(good, codec)[1] > 0

    return any(undo_utf8(word, codec, lambda good, around, codec=codec: accept(good, around, codec))[1] for codec in READ_AS)


def _pairs_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``pair, n`` to be added for words, with their neighbours, that are taken out."""
    for b in batches:
        parts = [_codes([w])[1:-1] for w in b.column(0).to_pylist()]
        if parts:
            pairs = np.concatenate([c[:-1] * _BASE + c[1:] for c in parts])
            pairs, n = _added(pairs, np.repeat(b.column(1).to_numpy(zero_copy_only=False), [len(c) - 1 for c in parts]))
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(-n)], names=["pair", "n"])


def word_options(words: DataFrame) -> DataFrame:
    """``word, n, options``: for each word the known words that one-byte inverse mappings give, with their counts."""

    def tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(w, k, fixed) for w in b.column(0).to_pylist() for k, fixed in _inverses(w)]
            cols = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string())], names=["word", "k", "fixed"])

    known = words.select(F.col("word").alias("fixed"), F.col("n").alias("m"))
    found = words.select("word").mapInArrow(tried, "word string, k int, fixed string").join(known, "fixed")
    listed = found.groupBy("word").agg(F.collect_list(F.struct("k", "fixed", "m")).alias("options"))
    return words.join(listed, "word", "left")


def _confusable(least: Column) -> Column:
    """Whether an inverse mapping makes the word (``n``, ``options``) more common by more than ``least`` bits."""
    none = F.array().cast("array<struct<k: int, fixed: string, m: bigint>>")
    return F.exists(F.coalesce("options", none), lambda o: F.log2((o["m"] + 0.5) / (F.col("n") + 0.5)) >= least)


class WordBitmap:
    """A bit for each word; a word whose bit isn't set was never put in."""

    def __init__(self, words: np.ndarray) -> None:
        self.words, self.mask = words, len(words) * 64 - 1

    @classmethod
    def of(cls, words: DataFrame) -> WordBitmap:
        bits = LEAST_BITS
        while bits < min(MOST_BITS, words.count() * BITS_PER_WORD):
            bits *= 2
        spots = words.select(F.crc32(F.encode("word", "UTF-8")).bitwiseAND(F.lit(bits - 1)).alias("bit"))
        got = spots.groupBy(F.shiftright("bit", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, CAST(bit & 63 AS INT)))").alias("v")).toPandas()
        out = np.zeros(bits // 64, np.int64)
        out[got["at"].to_numpy(dtype=np.int64)] = got["v"].to_numpy(dtype=np.int64)
        return cls(out.view(np.uint64))

    def may_hold(self, word: str) -> bool:
        bit = zlib.crc32(word.encode("utf-8", "surrogatepass")) & self.mask
        return bool(int(self.words[bit >> 6]) >> (bit & 63) & 1)


def fit_pairs(docs: DataFrame, scratch: Scratch, text: str = "text") -> tuple[tuple, DataFrame]:
    """(what a `PairModel` is made of, `word_options` of all words). The tables that are collected are bounded by the characters and their
    classes: see ``EPSILON``."""
    counts = scratch.keep(count_pairs(docs, text), "counts")
    placed = counts.where("word IS NOT NULL").select(F.expr("substring(word, 2, length(word) - 2)").alias("word"), F.col("word").alias("placed"), "n")
    words = scratch.keep(word_options(placed.groupBy("word").agg(F.sum("n").alias("n"))), "words")
    pairs = counts.where("pair IS NOT NULL").select("pair", "n")
    shared = docs.sparkSession.sparkContext.broadcast(_kept(scratch.keep(_classed(pairs), "raw"))[0])

    def damaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = set(shared.value.tolist())
        chars = {k // _BASE for k in known} | {k % _BASE for k in known}
        for b in batches:
            bad = [c or _damaged(w, known, chars) for w, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(bad, pa.bool_()))], names=["word"])

    confused = _confusable(F.when(F.length("word") > 1, PRIOR).otherwise(2 * PRIOR))
    bad = words.select("word", confused.alias("confused")).mapInArrow(damaged, "word string")
    out = placed.join(bad, "word").select("placed", "n").mapInArrow(_pairs_out, "pair long, n long")
    reference = scratch.keep(_classed(pairs.unionByName(out).groupBy("pair").agg(F.sum("n").alias("n")).where("n > 0")), "reference")

    def summed(key: str) -> tuple[np.ndarray, np.ndarray]:
        got = reference.groupBy(key).agg(F.sum("n").alias("n")).orderBy(key).toPandas()
        return got[key].to_numpy(dtype=np.int64), got["n"].to_numpy(dtype=np.int64)

    return (*_kept(reference), summed("x"), summed("y"), summed("cell")), words


def _classed(pairs: DataFrame) -> DataFrame:
    """``pair, n, x, y, cell``: the characters of each pair and their classes."""

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = np.divmod(b.column(0).to_numpy(zero_copy_only=False), _BASE)
            cell = [char_class(i) * 1024 + char_class(j) for i, j in zip(x.tolist(), y.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(x), pa.array(y), pa.array(cell, pa.int64())], names=["pair", "n", "x", "y", "cell"])

    return pairs.mapInArrow(classed, "pair long, n long, x long, y long, cell long")


def _kept(classed: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Pairs and counts of at least EPSILON of the pairs of their classes."""
    sums = classed.groupBy("cell").agg(F.sum("n").alias("of"))
    kept = classed.join(sums, "cell").where(F.col("n") >= EPSILON * F.col("of")).select("pair", "n").toPandas()
    return kept["pair"].to_numpy(dtype=np.int64), kept["n"].to_numpy(dtype=np.int64)


def find_garbled(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, undone, restored`` for every garbled text; ``restored`` is NULL where characters were lost.

    NULL and empty texts are clean. Repeated texts are judged alike (``doc_id`` must be unique). Statistics cover all texts given; no text is
    sampled or cut.
    """
    scratch = Scratch(spark, "garbled")
    fitted, words = fit_pairs(docs, scratch, text)
    shared = spark.sparkContext.broadcast(fitted)
    marked = spark.sparkContext.broadcast(WordBitmap.of(words.where(_confusable(F.lit(PRIOR)))).words)
    kind = docs.schema[doc_id].dataType.simpleString()

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts with UTF-8 steps to undo, which are undone, and texts with a confusable word in a run; ``words`` are those of the latter."""
        model, confusable = PairModel(*shared.value), WordBitmap(marked.value)
        for batch in batches:
            ids: list[int] = []
            cols: list[tuple] = []
            texts = batch.column(1).to_pylist()
            for at, scores in _scored(texts, model):
                t = texts[at]
                runs = improbable_runs(t, model, scores)
                if not runs:
                    continue
                if is_lost(t, runs):
                    row = (["lost"], None, None)
                else:
                    t, undone, runs = undo_utf8_steps(t, runs, model)
                    words = list(odd_words(t)) if runs else []
                    doubtful = any(a < y and x < b and confusable.may_hold(t[a:b]) for x, y in runs for a, b in words)
                    row = (undone, t, sorted({t[a:b] for a, b in words}) if doubtful else None)
                if row[0] or row[2]:
                    ids.append(at)
                    cols.append(row)
            strings = pa.list_(pa.string())
            undone, restored, listed = list(zip(*cols, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(ids, pa.int64())), pa.array(undone, strings), pa.array(restored, pa.string()), pa.array(listed, strings)], names=["doc_id", "undone", "restored", "words"]
            )

    found = scratch.keep(docs.select(doc_id, text).mapInArrow(suspects, f"doc_id {kind}, undone array<string>, restored string, words array<string>"), "suspects")
    named = found.where("words IS NOT NULL").select("doc_id", F.explode("words").alias("word"))
    known = named.join(words, "word").groupBy("doc_id").agg(F.collect_list(F.struct("word", "n", "options")).alias("known"))

    def confused(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PairModel(*shared.value)
        for batch in batches:
            new, how = [], []
            for undone, t, known in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                options = {w["word"]: (w["n"], {o["k"]: (o["fixed"], o["m"]) for o in w["options"] or ()}) for w in known or ()}
                if options:
                    t, more = undo_confusions(t, improbable_runs(t, model), model, options)
                    undone = undone + more
                new.append(t)
                how.append("; ".join(undone) or None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(how, pa.string()), pa.array(new, pa.string())], names=["doc_id", "undone", "restored"])

    judged = found.join(known, "doc_id", "left").select("doc_id", "undone", "restored", "known").mapInArrow(confused, f"doc_id {kind}, undone string, restored string")
    return judged.where("undone IS NOT NULL")


def _scored(texts: list[str | None], model: PairModel) -> Iterator[tuple[int, np.ndarray]]:
    """(place, scores) of the texts in which pairs score enough to make a run; about ``CHUNK`` characters are scored at once."""
    held: list[int] = []
    size = 0
    for k, t in enumerate(texts):
        if t and not t.isascii():
            held.append(k)
            size += len(t) + 1
        if held and (size >= CHUNK or k == len(texts) - 1):
            scores = model.scores(_codes([texts[i] for i in held]))  # type: ignore[misc]
            ends = np.cumsum([len(texts[i]) + 1 for i in held])  # type: ignore[arg-type]
            rising = np.concatenate([[0.0], np.cumsum(np.maximum(scores, 0.0))])
            starts = ends - np.diff(ends, prepend=0)
            for j in np.flatnonzero(rising[ends] - rising[starts] >= RUN).tolist():
                yield held[j], scores[starts[j] : ends[j] - 1]
            held, size = [], 0
