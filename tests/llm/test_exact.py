"""Operators with one right answer, against brute force on a corpus of hard cases."""

from collections import Counter

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plaudit.llm import contamination, rules, simhash, substring, suffix
from plaudit.llm.registry import LLM_QUERIES, contaminated

DOC_ID = "doc.doc_id"


def rows_of(frame):
    return Counter(tuple(r) for r in frame.collect())


def substring_rows(frame):
    return rows_of(frame.select(DOC_ID, "n_words", "n_removed", F.sha2("kept_text", 256)))


@pytest.mark.parametrize("hot", [10_000, 2])
@pytest.mark.parametrize("window", [13, 3])
def test_substring(docs, corpus, hot, window):
    got = substring_rows(substring.without_repeats(docs, window=window, hot=hot, max_bits=18))
    assert got == Counter(brute.substring(corpus, window))


def test_substring_with_a_full_sketch(docs, corpus):
    """A sketch far too small lets more windows pass and changes nothing."""
    got = substring_rows(substring.without_repeats(docs, max_bits=4))
    assert got == Counter(brute.substring(corpus))


def test_substring_carries_columns(docs, nothing):
    rows = substring.without_repeats(docs, carry=docs.columns)
    assert rows.schema["doc"].dataType.names == docs.select("doc_id", "text", *docs.columns[2:]).columns
    assert rows.select("doc.score").distinct().collect() == [("x",)]
    assert substring.without_repeats(nothing).count() == 0


ITEMS = [(1, "WAS it"), (2, None), (3, ""), (None, "one two"), (4, "one"), (4, "w1 W2 w3 w4"), (5, "... 123 ..."),
         (6, "w0 " + " ".join(f"w{k % 7}" for k in range(1, 40))), (7, "日本語のテキスト 日本語のテキスト")]


@pytest.mark.parametrize("block_bytes", [8 << 20, 60])
def test_contamination(spark, docs, corpus, block_bytes):
    long_one = next(t for i, t in corpus if i == 17)
    items = [*ITEMS, (8, long_one[500:900]), (9, long_one[700:1200])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = contamination.searched(docs, bench, block_bytes=block_bytes)
    got = rows_of(rows.select(DOC_ID, "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256),
                              contaminated()))
    assert got == Counter(brute.contamination(corpus, items))
    assert contamination.searched(docs, bench.limit(0)).agg(F.sum("n_hit")).first()[0] == 0


def test_a_long_item_is_several_runs(spark, docs, corpus):
    """Every window is in one run, and no run is longer than asked for; blocks are searched one at a time."""
    long_one = next(t for i, t in corpus if i == 17)
    bench = spark.createDataFrame([(1, long_one), (2, "a b"), (3, "")], "item_id long, text string")
    runs = contamination.runs_of(bench.selectExpr("cast(item_id as string) item", "text"), 13, 100).collect()
    windows = Counter()
    for r in runs:
        words = r.text.split()
        assert len(words) <= 112
        windows.update((r.item, tuple(words[k:k + 13])) for k in range(max(1, len(words) - 12)))
    words = brute.PLAIN.findall(brute.lower(long_one))
    assert windows == Counter({**{("1", tuple(words[k:k + 13])): 1 for k in range(len(words) - 12)}, ("2", ("a", "b")): 1})
    rows = contamination.searched(docs, bench, block_bytes=9000, run_windows=1000)
    got = rows_of(rows.select(DOC_ID, "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256), contaminated()))
    assert got == Counter(brute.contamination(corpus, [(1, long_one), (2, "a b")]))


def test_contamination_spans(spark, docs):
    bench = spark.createDataFrame([(1, "w1 w2 w3")], "item_id long, text string")
    row = contamination.searched(docs, bench).filter("doc.doc_id = 24").first()
    assert row.hits[0].item == "1" and row.hits[0].start == 1 and row.hits[0].stop == 4


def test_repeated_items_are_taken_once(spark, docs, monkeypatch):
    """Copies of a benchmark row share a block, which they must not fill."""
    taken, patterns_of = [], contamination.patterns_of

    def recorded(items, window):
        taken.append(items)
        return patterns_of(items, window)

    monkeypatch.setattr(contamination, "patterns_of", recorded)
    bench = spark.createDataFrame([(1, "w1 w2 w3")] * 200, "item_id long, text string")
    row = contamination.searched(docs, bench, block_bytes=60).filter("doc.doc_id = 24").first()
    assert taken == [[("1", "w1 w2 w3")]] and row.items == ["1"]


def suffix_rows(frame):
    return rows_of(frame.select(DOC_ID, "n_bytes", "n_removed", F.size("removed"), F.sha2("kept", 256)))


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize(("length", "most"), [(400, 4 << 20), (100, 4 << 20), (100, 300), (7, 2000)])
def test_suffix(docs, corpus, keep, length, most):
    """With a small `most` the classes are dealt anew, up to the last round."""
    chosen, rows = docs, corpus
    if keep == "first":  # repeated rows have no order
        rows = [r for k, r in enumerate(corpus) if r[0] is not None and r not in corpus[:k]]
        chosen = docs.dropDuplicates(["doc_id", "text"]).dropna(subset=["doc_id"])
    got = suffix_rows(suffix.without_repeats(chosen, length=length, keep=keep, most=most, max_bits=18))
    assert got == Counter(brute.suffix(rows, length, keep))


@given(st.lists(st.text("ab", max_size=30), min_size=1, max_size=6), st.integers(1, 20))
@settings(max_examples=200, deadline=None)
def test_factors(texts, depth):
    """Longest previous and next factors against a comparison of all places."""
    data, offsets = np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *map(len, texts)])
    strings = {offsets[r] + k: t[k:k + depth] for r, t in enumerate(texts) for k in range(len(t) - depth + 1)}

    def longest(at, others):
        return max((next((k for k in range(depth) if strings[at][k] != strings[o][k]), depth) for o in others), default=0)

    want = [([longest(a, [o for o in strings if o < a]), longest(a, [o for o in strings if o > a])] if a in strings else [0, 0])
            for a in range(len(data))]
    previous, following = suffix.factors(data, offsets, depth)
    assert np.stack([previous, following], 1).tolist() == want
    assert not suffix.factors(data, offsets, depth, following=False)[1].any()


@given(st.lists(st.integers(0, 9), max_size=60))
def test_smaller_before(values):
    want = [max((j for j in range(i) if values[j] < v), default=-1) for i, v in enumerate(values)]
    assert suffix.smaller_before(np.array(values, np.int64)).tolist() == want


def test_suffix_of_nothing(nothing):
    assert suffix.without_repeats(nothing).count() == 0
    with pytest.raises(ValueError):
        suffix.without_repeats(nothing, keep="last")


def test_rules(docs, corpus, nothing):
    rows = rules.judged(docs)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert rows_of(rows.select(columns)) == Counter(brute.rules(corpus))
    assert rows.filter("base_failed and kept").count() == 0
    assert rows.filter("kept is null").count() == 0
    assert rules.judged(nothing).count() == 0


def test_rules_divergence(spark):
    same = F.array(*[F.lit(x) for x in (0.5, 0.5, 0.0)])
    far = F.array(*[F.lit(x) for x in (0.0, 0.0, 1.0)])
    row = spark.range(1).select(rules.distance(same, same).alias("a"), rules.distance(same, far).alias("b")).first()
    assert (row.a, row.b) == (0.0, 1.0)
    none = F.lit(None).cast("array<double>")
    row = spark.range(1).select(rules.distance(same, none).alias("a"), rules.distance(none, same).alias("b")).first()
    assert (row.a, row.b) == (None, None)


def test_common_words(spark):
    """By language, null among them; ties by bytes; no word without a letter, none that is too long."""
    rows = [(1, "B b a | | | A c", "en"), (2, "z " * 3 + "x" * 41 + " é É", "en"), (3, "- 1 2", "de"), (4, "q", None),
            (5, None, "fr"), (6, " ".join(f"w{k:02}" for k in range(20)), "es")]
    found = rules.common_words(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "text", "lang")
    got = {r.of: r.listed for r in found.collect()}
    assert got == {"en": ["z", "a", "b", "c", "É", "é"], None: ["q"], "es": [f"w{k:02}" for k in range(13)]}


def test_short_texts_are_not_judged(docs, corpus):
    """Null, not zero, below the least lengths and without a word list."""
    rows = {r.doc_id: r for r in rules.judged(docs).collect()}
    assert rows[9].char_distance is None and rows[9].word_distance is None
    assert rows[17].char_distance is not None


def test_rules_are_native(docs):
    plan = rules.measured(docs, "doc_id", "text", "lang")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def fingerprint_rows(frame):
    return rows_of(frame.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")), "component_id"))


@pytest.mark.parametrize("group", [512, 2])
def test_simhash(docs, corpus, group):
    assert fingerprint_rows(simhash.near_copies(docs, group=group)) == Counter(brute.near_copies(corpus))


@pytest.mark.parametrize("group", [512, 3])
def test_links_of_a_dense_cluster(spark, group):
    """Fingerprints all around a centre, so that groups are refined down to the last level."""
    import random

    rng = random.Random(5)
    centre = rng.getrandbits(64)
    prints = sorted({centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 7))) for _ in range(250)}
                    | {rng.getrandbits(64) for _ in range(50)} | {0, (1 << 64) - 1})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p, k) for k, p in enumerate(signed)], "print long, id long")
    got = {r.print: r.component_id for r in simhash.classes(frame, group=group).collect()}
    assert [got[p] for p in signed] == brute.linked(prints)


def test_simhash_of_nothing(nothing):
    assert simhash.near_copies(nothing).count() == 0
    with pytest.raises(ValueError):
        simhash.links(nothing, distance=4)


def test_one_of_each(docs, corpus):
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    expected = {c for _, _, c in brute.near_copies(corpus)} - {None}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(expected)


def test_one_of_each_where_ids_repeat(spark):
    """Rows of one id in several components: each component keeps one row, and it is its own."""
    one, two, three, four, five = (" ".join(f"{c}{k * k}" for k in range(40)) for c in "abcde")
    rows = [(1, one), (1, two), (1, three), (1, one), (2, one), (2, four), (3, four), (None, two), (None, five),
            (None, five), (4, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(
        [(1, one), (1, two), (1, three), (2, four), (None, five), (4, None)])


@pytest.mark.parametrize(("name", "work"), [
    ("op2_substring_dedup", brute.substring), ("op5_suffix_array_dedup", brute.suffix),
    ("op10_simhash_near_dedup", brute.near_copies)])
def test_queries(spark, sf_dir, name, work):
    table = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(LLM_QUERIES[name](spark, sf_dir)) == Counter(work(table))
