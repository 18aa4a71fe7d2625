"""The learned operators' steps against plain versions: out-of-place distances, compressed sizes, calibration."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard

from plaudit.llm import language, quality
from plaudit.llm.logistic import Logistic


def grams(text):
    """N-grams of each run of letters, with its edges; numbered as a text of up to three code points of 21 bits."""
    words, word = [], ""
    for c in (text or "").lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            words.append(word)
            word = ""
    found = Counter()
    for word in words:
        edged = [1, *map(ord, word), 1]
        found.update(edged[1:-1])
        found.update((a << 21) + b for a, b in zip(edged, edged[1:]))
        found.update((((a << 21) + b) << 21) + c for a, b, c in zip(edged, edged[1:], edged[2:]))
    return found


def by_rank(counts, ranks):
    order = sorted(counts, key=lambda g: (-counts[g], g))[:ranks]
    return {gram: k for k, gram in enumerate(order)}


def out_of_place(document, profile, ranks):
    return sum(min(abs(profile[g] - k), ranks) if g in profile else ranks for g, k in document.items()) / len(document) / ranks


TEXTS = {
    "en": ["the cat sat on the mat and the dog was there", "Where is the house? It's over there.", None, "a b a"],
    "de": ["die Katze saß auf der Matte und der Hund war da", "Wo ist das Haus? Dort drüben.", "der der der"],
    "el": ["η γάτα κάθισε στο χαλί", "Πού είναι το σπίτι; Εκεί."],
}
OTHERS = ["the house", "das Haus und die Katze", "το σπίτι", "123 !!", "", None, "zzz", "a", "İstanbul ŉ ß ǅ", "日本語 テキスト"]


@pytest.mark.parametrize("ranks", [300, 7])
def test_out_of_place(spark, ranks):
    """Profiles, distances, the nearest language and the score, for learned and for other texts."""
    rows = [(k, text, lang) for k, (lang, text) in enumerate((n, t) for n, own in TEXTS.items() for t in own)]
    docs = spark.createDataFrame(rows + [(100 + k, t, None) for k, t in enumerate(OTHERS)],
                                 "doc_id long, text string, lang string")
    profiles = language.fitted(docs, ranks=ranks)
    totals = defaultdict(Counter)
    for _, text, lang in rows:
        totals[lang] += grams(text)
    plain = {lang: by_rank(counts, ranks) for lang, counts in totals.items()}
    got = {r.doc.doc_id: (r.lang_pred, r.score) for r in language.identified(docs, profiles).collect()}
    for id, text in [(r[0], r[1]) for r in rows] + [(100 + k, t) for k, t in enumerate(OTHERS)]:
        document = by_rank(grams(text), ranks)
        if not document:
            assert got[id] == ("und", 0.0)
            continue
        far = {lang: out_of_place(document, profile, ranks) for lang, profile in sorted(plain.items())}
        best = min(far, key=lambda lang: (far[lang], lang))
        near = {lang: math.exp(-language.SHARPNESS * (d - far[best])) for lang, d in far.items()}
        assert got[id][0] == best and got[id][1] == pytest.approx(1 / sum(near.values()), rel=1e-9)


def test_compressed_sizes(spark):
    """The feature of every text is the difference of two plain sums of compressed pieces."""
    texts = [f"good words flow in calm and ordered lines, number {k}, " * (k % 40 + 1) for k in range(60)]
    bad = [f"CLICK {k} now!!! win $$$ fr33 {k * 7} " * (k % 40 + 1) for k in range(60)]
    rows = [(k, t, int(k < 60)) for k, t in enumerate(texts + bad)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(500, None), (501, ""), (502, "é" * 5000)],
                                 "doc_id long, text string")
    model = quality.fitted(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int"))

    def size(data, dictionary):
        own = zstandard.ZstdCompressor(level=quality.LEVEL, write_content_size=False,
                                       dict_data=zstandard.ZstdCompressionDict(dictionary))
        return sum(len(own.compress(data[at:at + 2048])) for at in range(0, len(data), 2048))

    calibrated, scores = model.calibrated, {r.doc.doc_id: r.score for r in quality.scored(docs, model).collect()}
    for row in docs.collect():
        data = (row.text or "").encode()
        good, other = (size(data, d) for d in model.compression.parts)
        apart = (other - good) / (other + good) if data else 0.0
        x = min(8, max(-8, (apart - calibrated.mean[0]) / calibrated.scale[0]))
        want = 1 / (1 + math.exp(-(calibrated.weights[0] + calibrated.weights[1] * x)))
        assert scores[row.doc_id] == pytest.approx(want, rel=1e-9)
    assert all((scores[i] > 0.5) == (y == 1) for i, _, y in rows)


def test_calibration_is_the_likeliest():
    """No small change of a weight makes the penalised likelihood larger."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 2))
    y = (x @ [1.0, -2.0] + rng.normal(size=200) > 0.3).astype(int)
    model = Logistic(x, y)
    scaled = np.c_[np.ones(200), (x - x.mean(0)) / x.std(0)]

    def loss(weights):
        p = 1 / (1 + np.exp(-(scaled @ weights)))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum() + 0.5 * (weights[1:] ** 2).sum()

    least = loss(model.weights)
    for k in range(3):
        for step in (-1e-3, 1e-3):
            assert loss(model.weights + step * np.eye(3)[k]) > least
