"""Learned operators: held-out accuracy, hard cases, and the parts that have one right answer."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plaudit.llm import language, quality, toxicity
from plaudit.llm.logistic import Logistic
from plaudit.llm.registry import LLM_QUERIES

LARGER = "/root/testdata/sf0.01"


def auc(scores, labels):
    order = np.argsort(np.argsort(scores, kind="stable"), kind="stable") + 1
    labels = np.array(labels)
    ones = labels.sum()
    return (order[labels == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(labels) - ones))


def judged(spark, name, label):
    rows = LLM_QUERIES[name](spark, LARGER)
    labels = spark.read.parquet(f"{LARGER}/labels.parquet").select("doc_id", label)
    assert rows.count() == spark.read.parquet(f"{LARGER}/documents.parquet").count()
    return rows.join(labels, "doc_id").filter("held_out").collect()


def test_toxicity_query(spark):
    rows = judged(spark, "op1_toxicity", "toxic")
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    found = [r for r in rows if r.predicted]
    assert len(found) >= 10 and all(r.toxic for r in found)
    assert auc([r.score for r in rows], [r.toxic for r in rows]) > 0.8


def test_quality_query(spark):
    rows = judged(spark, "op7_quality_classifier", "quality")
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert auc([r.score for r in rows], [r.quality for r in rows]) > 0.9


def test_language_query(spark):
    rows = LLM_QUERIES["op6_language_id"](spark, LARGER).join(
        spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.lang == r.lang_pred for r in rows) > 0.98 * len(rows)


def test_language_cases(docs, nothing, corpus):
    profiles = language.fitted(docs)
    rows = language.identified(docs, profiles).collect()
    assert len(rows) == len(corpus)
    for r in rows:
        letters = any(c.isalpha() for c in r.doc.text or "")
        assert (r.lang_pred == "und") != letters and (letters or r.score == 0)
    empty = language.fitted(nothing)
    assert empty.names == [] and language.identified(docs, empty).filter("lang_pred <> 'und'").count() == 0
    assert language.identified(nothing, profiles).count() == 0


def test_language_profile_ties():
    codes, counts = language.grams("ab ab")
    assert language.ranked(codes, counts, 3).tolist() == sorted(codes[counts == counts.max()].tolist())[:3]


@pytest.mark.parametrize(("module", "label"), [(toxicity, "toxic"), (quality, "quality")])
def test_scores_of_hard_cases(spark, docs, nothing, corpus, module, label):
    few = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (None, 1), (99, 0), (3, None), (17, 0)], f"doc_id long, {label} int")
    for labels in (few, few.limit(0), few.filter(f"{label} = 1")):
        model = module.fitted(docs, labels)
        rows = module.scored(docs, model).collect()
        assert len(rows) == len(corpus) and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if not (r.doc.text or "").strip()}) >= 1
    assert module.scored(nothing, module.fitted(nothing, few)).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


TERMS = [toxicity.Term(t, s, 1.0) for t, s in (("idiot", False), ("disgusting", False), ("ass", False), ("vequle", True),
                                               ("idioms", False), ("low", True))]


@given(st.text("idotsguvelqw", max_size=12) | st.sampled_from(["idoit", "1diot", "disgstng", "vequla", "veqle", "lowest"]))
@settings(max_examples=400, deadline=None)
def test_automaton(word):
    best = []
    for k, term in enumerate(TERMS):
        room = toxicity.edits_allowed(term)
        ends = range(len(word) + 1) if term.stem else [len(word)]
        edits = min(distance(term.text, word[:n]) for n in ends)
        if edits <= room:
            best.append((edits, -term.weight, k))
    found = AUTOMATON.match(word)
    assert found == ((min(best)[2], min(best)[0]) if best else None)


AUTOMATON = toxicity.Automaton(TERMS)


def test_misspelling_and_quotation():
    lexicon = toxicity.Lexicon([toxicity.Term("idiot", False, 5.0), toxicity.Term("pathetic", False, 5.0)])
    features = np.array([[0, 0]] * 50 + [[np.log1p(5.0), 5.0]] * 50, float)
    model = toxicity.Toxicity(lexicon, {}, Logistic(features, np.r_[np.zeros(50), np.ones(50)]))
    plain, misspelt, quote, clean = model.scores(
        ["he is an idiot today", "he is an idjot today", 'the word "idiot" is an old one', "nothing to see here"])
    assert plain > 0.7 and plain > misspelt > clean and plain > quote and clean < 0.1
    both = model.scores(["you pathetic idiot"])[0]
    assert both >= plain


def test_toxic_terms_beside_much_copied_documents(spark):
    """The words of one copied document are more than 20,000 terms, each in more documents than the toxic word."""
    rng = random.Random(3)

    def words(n):
        return ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(n)]

    copied = " ".join(words(5000))
    rows = [(copied, 1)] * 120 + [(" ".join([*words(6), "qwertz", *words(6)]), 1) for _ in range(80)]
    rows += [(" ".join(words(12)), 0) for _ in range(200)]
    docs = spark.createDataFrame([(k, t, y) for k, (t, y) in enumerate(rows)], "doc_id long, text string, toxic int")
    model = toxicity.fitted(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert [t.text for t in model.lexicon.automaton.terms] == ["qwertz"]
    toxic, clean = model.scores(["well qwertz then", "well well then"])
    assert toxic > clean


def test_toxicity_is_fitted_on_all_hits(spark):
    """Where the exact hits of a document begin does not matter for the trust in misspellings, nor the number of hits
    for what is fitted."""
    rng = random.Random(5)

    def words(n):
        return ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(n)]

    rows = [(" ".join([*words(6), "qwertz", *words(6)]), 1) for _ in range(100)]
    rows += [(" ".join([*words(4), *["qwurtz"] * 1500, "qwertz", *words(4)]), 1) for _ in range(40)]
    rows += [(" ".join(words(12)), 0) for _ in range(200)]
    docs = spark.createDataFrame([(k, t, y) for k, (t, y) in enumerate(rows)], "doc_id long, text string, toxic int")
    model = toxicity.fitted(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    by_term = {(model.lexicon.automaton.terms[term].text, edits) for term, edits in model.trust}
    assert "qwertz" in {t.text for t in model.lexicon.automaton.terms}
    assert not {(t, e) for t, e in by_term if t == "qwertz"}
    quarter = docs.selectExpr("text", "pmod(xxhash64('half', doc_id), 4) = 0 as judged").filter("judged").collect()
    features = np.array([model.features(r.text) for r in quarter])
    assert np.allclose(model.calibrated.mean, features.mean(axis=0))


def test_quality_learns_from_the_whole_of_long_texts(spark):
    """What tells the labels apart stands neither at the beginning nor in the middle."""
    rng = random.Random(4)

    def text(words, n):
        return " ".join(rng.choices(words, k=n))

    same, good, bad = ([f"{c}{rng.getrandbits(30):x}" for _ in range(300)] for c in "xyz")
    rows = [(k, " ".join([text(same, 700), text(good if k % 2 else bad, 300), text(same, 1000)]), k % 2)
            for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    built = quality.fitted(docs.select("doc_id", "text"), docs.select("doc_id", "quality")).compression.parts
    for dictionary, own, other in (*zip(built, (good, bad), (bad, good), strict=True),):
        assert sum(w.encode() in dictionary for w in own) > 100 > 0 == sum(w.encode() in dictionary for w in other)
    few = quality.fitted(docs.select("doc_id", "text"), docs.select("doc_id", "quality"), label_bytes=8 * quality.PIECE)
    assert all(0 < len(p) <= 8 * quality.PIECE for p in few.compression.parts)


def test_quality_is_not_told_by_length(spark):
    """Good texts are long and bad ones short, of the same words: only the sizes' difference may tell."""
    rng = random.Random(6)
    words = [f"{rng.getrandbits(32):x}" for _ in range(400)]
    rows = [(k, " ".join(rng.choices(words, k=1200 if k % 2 else 60)), k % 2) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality.fitted(docs.select("doc_id", "text"), docs.select("doc_id", "quality"))
    short, long = model.scores([" ".join(rng.choices(words, k=n)) for n in (60, 1200)])
    assert abs(long - short) < 0.3


def test_logistic_without_a_label():
    assert Logistic(np.zeros((0, 2)), np.zeros(0))(np.zeros((1, 2)))[0] == 0.5
    assert 0.9 < Logistic(np.ones((50, 2)), np.ones(50))(np.zeros((1, 2)))[0] < 1


def test_folds(spark):
    from plaudit.llm.rows import fold

    rows = spark.range(50).select("id", fold("id", 3).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 3 for r in rows)
    assert spark.sql("select cast(null as long) as id").select(fold("id", 3).eqNullSafe(1)).first()[0] is False


def test_samples_are_bounded(spark):
    from plaudit.llm.rows import sampled

    rows = spark.range(1000).select("id", F.when(F.col("id") < 900, 0).when(F.col("id") < 950, 1).alias("y"))
    counts = {r.y: r["count"] for r in sampled(rows, "y", "id", 60).groupBy("y").count().collect()}
    assert counts == {0: 60, 1: 50}
    smallest = rows.filter("y = 0").orderBy(F.xxhash64("id")).limit(60).select("id")
    assert sampled(rows.filter("y = 0"), "y", "id", 60).select("id").exceptAll(smallest).isEmpty()
