from __future__ import annotations

import random

import numpy as np
import pytest

from siftlane.llm import mojibake as mj

SENTENCES = {
    "fr": "L’équipe a trouvé une boîte à œufs tachée près du quai, déjà vérifiée après la relève.",
    "de": "Die überbelichtete Flasche wurde für Größe und Schärfe geprüft, nicht gezählt, später gelöscht.",
    "es": "¿Por qué la cápsula de café sigue aquí? Según el control, faltaba la anotación de mañana.",
    "pt": "ATENÇÃO: NÃO misturar papelão e metal amanhã; a câmera tremeu após a inspeção.",
    "pl": "Na białym stole leżała wyblakła puszka, którą zmiana uznała za częściowo zasłoniętą.",
    "ru": "На второй ленте найдена мокрая крышка, класс металл, потому что тень мешала.",
    "en": "There’s a crème brûlée pot – 12 °C – next to the “café” lid … and nobody could explain it.",
}


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    out = []
    for lang, s in SENTENCES.items():
        words = s.split()
        for _ in range(120):
            out.append((lang, s + " " + " ".join(rng.sample(words, 6))))
    return out


def garbled(text, true, wrong):
    return text.encode(true, "ignore").decode(wrong, "replace")


CASES = [
    ("fr", "utf-8", "cp1252"), ("de", "utf-8", "cp437"), ("es", "utf-8", "mac_roman"), ("pt", "utf-8", "latin_1"), ("ru", "utf-8", "cp1251"), ("fr", "utf-8", "cp850"),
    ("de", "cp1252", "cp437"), ("fr", "cp1252", "mac_roman"), ("es", "cp1252", "cp1251"), ("ru", "cp1251", "cp1252"), ("pl", "cp1250", "cp1252"),
]


@pytest.fixture(scope="module")
def table(corpus):
    docs, want = [], {}
    for _, text in corpus:
        docs.append(text)
    for lang, true, wrong in CASES:
        clean = SENTENCES[lang]
        bad = garbled(clean, true, wrong)
        if mj.LOST in bad or bad.encode(wrong, "ignore").decode(true, "ignore") != clean:
            clean = "".join(c for c in clean if garbled(c, true, wrong).encode(wrong, "ignore").decode(true, "ignore") == c and mj.LOST not in garbled(c, true, wrong))
            bad = garbled(clean, true, wrong)
        want[len(docs)] = clean
        docs.append(bad)
    want[len(docs)] = None
    docs.append(SENTENCES["fr"].replace("é", mj.LOST))
    twice = garbled(garbled(SENTENCES["es"].replace("ó", "o").replace("á", "a"), "utf-8", "latin_1"), "utf-8", "cp1252")
    want[len(docs)] = SENTENCES["es"].replace("ó", "o").replace("á", "a")
    docs.append(twice)
    part = SENTENCES["en"] + "\n" + garbled(SENTENCES["de"], "utf-8", "cp1252")
    want[len(docs)] = SENTENCES["en"] + "\n" + SENTENCES["de"]
    docs.append(part)
    return docs, want


def test_found_and_restored(spark, table):
    docs, want = table
    df = spark.createDataFrame([*((i, t, "no") for i, t in enumerate(docs)), (10_000, None, "no"), (10_001, "", "no"), (10_002, "plain text", "no")], "doc_id bigint, text string, undone string")
    got = {r["doc_id"]: r["restored"] for r in mj.find_garbled(spark, df).collect()}
    assert set(got) == set(want)
    exact = sum(got[i] == t for i, t in want.items())
    assert exact >= len(want) - 1, [(got[i], t) for i, t in want.items() if got[i] != t]


def test_empty(spark):
    assert mj.find_garbled(spark, spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def brute_segments(scores):
    """Maximal scoring segments by their recursive definition."""
    if not len(scores):
        return []
    total = np.concatenate([[0], np.cumsum(scores)])
    best, at = 0.0, None
    for a in range(len(scores)):
        for b in range(a + 1, len(scores) + 1):
            s = total[b] - total[a]
            if s > best + 1e-9 or (at and abs(s - best) <= 1e-9 and b - a < at[1] - at[0]):
                best, at = s, (a, b)
    if at is None:
        return []
    a, b = at
    return brute_segments(scores[:a]) + [at] + [(x + b, y + b) for x, y in brute_segments(scores[b:])]


@pytest.mark.parametrize("seed", range(25))
def test_maximal_segments(seed):
    rng = np.random.default_rng(seed)
    scores = rng.normal(size=rng.integers(0, 25))
    got = mj.maximal_segments(scores, 0.0)
    want = brute_segments(scores)
    assert sum(scores[a:b].sum() for a, b in got) == pytest.approx(sum(scores[a:b].sum() for a, b in want))
    assert len(got) == len(want)


def model_of(texts):
    codes = mj._codes(texts)
    pairs, n = np.unique(codes[:-1] * mj._BASE + codes[1:], return_counts=True)
    return mj.PairModel.of(pairs, n)


def test_long_text(corpus):
    model = model_of([t for _, t in corpus])
    text = SENTENCES["fr"] * 3000
    assert mj.restore(text, model) == (None, None)
    assert mj.restore(text + garbled(SENTENCES["de"], "utf-8", "cp1252"), model)[0] == text + SENTENCES["de"]


def test_mutual_information_and_not_frequency():
    """Ten times as many of a character, all in the same company: pair frequency would move by 3.3 bits, mutual information doesn't."""
    base = ["the lané of thé thing that rané on and on to a plané " * 20, "no accents stand in the rest of this text and it is long " * 5000]
    pair = ord("n") * mj._BASE + ord("é")
    scores = []
    for times in (1, 10):
        codes = mj._codes(base)
        pairs, n = np.unique(codes[:-1] * mj._BASE + codes[1:], return_counts=True)
        odd = (pairs // mj._BASE == ord("é")) | (pairs % mj._BASE == ord("é"))
        scores.append(float(mj.PairModel.of(pairs, np.where(odd, n * times, n) * 50).information(np.array([pair]))[0]))
    assert abs(scores[0] - scores[1]) < 0.5


def test_a_rare_character_is_fine_where_it_belongs(corpus):
    texts = [t for _, t in corpus] + ["the word naïve is rare", "it is naïve too", "naïve words"]
    model = model_of(texts)
    assert mj.restore("a naïve one", model) == (None, None)
    assert mj.improbable_runs("a na" + garbled("ï", "utf-8", "cp1252") + "ve one", model)


def test_quoted_replacement_characters_are_no_loss(spark, corpus):
    texts = [t for _, t in corpus] + ['decoders write "\ufffd" for a byte that is none', "the caf\ufffd is closed", "at 12 \ufffdC outside"]
    got = mj.find_garbled(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    assert {(r["doc_id"] - len(corpus), r["undone"]) for r in got.collect()} == {(1, "lost"), (2, "lost")}


def test_unspaced_scripts_have_no_words():
    text = "中文句子没有空格é 日本語のテキスト"
    assert [text[a:b] for a, b in mj.odd_words(text)] == ["é"]


def test_counting_in_chunks(corpus, monkeypatch):
    texts = [t for _, t in corpus[:60]] + ["x" * 250, "ab" * 200, "é"]
    codes = mj._codes(texts)
    pairs, n = np.unique(codes[:-1] * mj._BASE + codes[1:], return_counts=True)
    monkeypatch.setattr(mj, "CHUNK", 100)
    got = dict(zip(*[a.tolist() for a in mj._count_codes(texts)], strict=True))
    want = dict(zip(pairs.tolist(), n.tolist(), strict=True))
    # Between two texts there is one line end, or two where a chunk ends.
    line = 32 * mj._BASE + 32
    got.pop(line, None)
    want.pop(line, None)
    ends = {k for k in got if k // mj._BASE == 32 or k % mj._BASE == 32}
    assert {k: v for k, v in got.items() if k not in ends} == {k: v for k, v in want.items() if k not in ends}
    assert all(abs(got[k] - want[k]) <= 0 for k in ends)


def test_every_garbled_passage_is_restored(corpus):
    texts = [t for _, t in corpus]
    words = {}
    for t in texts:
        for a, b in mj.odd_words(t):
            words[t[a:b]] = words.get(t[a:b], 0) + 1
    model = model_of(texts)
    de, ru, fr = SENTENCES["de"], SENTENCES["ru"], SENTENCES["fr"]

    def check(bad, good):
        known = mj.options_of(words | {bad[a:b]: 1 for a, b in mj.odd_words(bad) if bad[a:b] not in words})
        assert mj.restore(bad, model, known)[0] == good

    check(garbled(de, "cp1252", "cp437") + "\n" + fr + "\n" + garbled(ru, "cp1251", "cp1252"), de + "\n" + fr + "\n" + ru)
    check(garbled(de, "utf-8", "cp1252") + "\n" + fr + "\n" + garbled(ru, "cp1251", "cp1252"), de + "\n" + fr + "\n" + ru)
