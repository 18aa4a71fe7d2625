"""Quality rules by distribution divergence, in DataFrame functions only.

A document's shares of character classes, and its shares of the commonest words of its language, are compared
with a reference of that language by Jensen-Shannon distance (base 2, from 0 to 1). The commonest words are counted over all
texts of the language, capitals A-Z as small letters; of equally common ones the smaller comes first. Words without a letter, and
those of over 40 characters, are none of them. The references are the mean shares over all
documents of the language that pass the minimum lengths. A document is judged by characters from `least_chars` word
characters on, and by words from `least_words` words on; a shorter one is not judged by that measure. Language null is a
language of its own.

Null and empty texts have no words; texts of any length are measured whole. Repeated rows get the same answer each. No rows
give none. Only id, text and language are looked at, whatever other columns are called.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plaudit.llm.rows import checkpointed

#: Fixed values, as patterns: characters by class.
SPACE = r"[\x20\x09-\x0D]"
LOWER_OR_SPACE = r"[a-z\x20\x09-\x0D\p{Ll}]"
OTHERS = {"upper": r"\p{Lu}", "digits": "[0-9]", "symbols": "[#*$%&|<>]", "punctuation": r"[.,;:!?'\"()\-]"}
N_CLASSES = 7
N_COMMON = 13  # words in a language's list
LONGEST = 40


def small(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def _less(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, f"{pattern}+", "")


def _hashes(words: Column) -> Column:
    """A hash of each 3-word window."""
    places = F.sequence(F.lit(0), F.size(words) - 3)
    return F.when(F.size(words) < 3, F.array().cast("array<long>")).otherwise(
        F.transform(places, lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2])))


def _repeated_words(words: Column, hashes: Column) -> Column:
    """Words that lie in a 3-word window whose words come again. If the windows' hashes are not all different, windows are
    sorted by 96 bits of hash; neighbours are compared, and the places of the equal ones are put in order again."""
    windows = F.transform(hashes, lambda h, i: F.struct(
        h.alias("a"), F.hash(words[i], words[i + 1], words[i + 2]).alias("b"), i.alias("i")))

    def same(x: Column, y: Column) -> Column:
        return (x["a"] == y["a"]) & (x["b"] == y["b"])

    def places(ordered: Column) -> Column:
        return F.filter(F.transform(ordered, lambda x, k: F.when(
            ((k > 0) & same(ordered[F.greatest(k - 1, F.lit(0))], x))
            | ((k + 1 < F.size(ordered)) & same(ordered[F.least(k + 1, F.size(ordered) - 1)], x)), x["i"])),
            lambda i: i.isNotNull())

    def covered(at: Column) -> Column:
        return F.aggregate(at, F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")), lambda s, i: F.struct(
            i.alias("last"), (s["n"] + F.least(F.lit(3), i - s["last"])).alias("n")), lambda s: s["n"])

    # The one-element array binds what the inner functions look into, so that it is made once for each row.
    found = covered(F.sort_array(F.transform(F.array(F.sort_array(windows)), places)[0]))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(found)


def _classes(text: Column, rest: Column, word_chars: Column) -> Column:
    """Characters by class; `rest` is what neither lower case nor space is."""
    left = F.char_length(rest)
    known = [left - F.char_length(_less(rest, pattern)) for pattern in OTHERS.values()]
    space = F.char_length(text) - word_chars
    return F.array(*[c.cast("long") for c in (
        *known, left - sum(known[1:], known[0]), space, word_chars - left)])


def common_words(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(of, listed): the commonest words of each language, most common first. Words are counted in the tasks before the
    shuffle, and a task keeps a list's length of each language at most."""
    words = docs.select(F.col(lang).alias("of"), F.explode(F.split(small(F.col(text)), f"{SPACE}+")).alias("word"))
    counts = words.where((F.col("word") != "") & (F.char_length("word") <= LONGEST)).groupBy("of", "word").agg(
        F.count("*").alias("n"))
    order = Window.partitionBy("of").orderBy(F.desc("n"), "word")
    counts = counts.where(F.col("word").rlike(r"\p{L}"))
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= N_COMMON)
    return top.groupBy("of").agg(F.sort_array(F.collect_list(F.struct("rank", "word"))).getField("word").alias("listed"))


def _counted(words: Column, listed: Column) -> Column:
    """How often each listed word occurs, and all others; null without a list. Each listed word gets a letter; the text of
    all letters is as much shorter without one as the word is frequent. A short list is filled up with zeros."""
    letters = "abcdefghijklm"
    chosen = F.filter(F.transform(words, small), lambda w: F.array_contains(listed, w))
    line = F.array_join(F.transform(chosen, lambda w: F.substring(
        F.lit(letters), F.array_position(listed, w).cast("int"), F.lit(1))), "")
    counts = F.transform(F.array(line), lambda x: F.array(
        *[(F.length(x) - F.length(F.replace(x, F.lit(letter), F.lit("")))).cast("long") for letter in letters],
        (F.size(words) - F.length(x)).cast("long")))[0]
    return F.when(listed.isNotNull(), counts)


def _by_language(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Rows with what a table holds for their language, one row for each."""
    table = checkpointed(table)
    if table.count() <= 10_000:
        table = F.broadcast(table)
    return rows.join(table, F.col("lang").eqNullSafe(F.col("of")), "left").drop("of")


def measured(docs: DataFrame, id: str, text: str, lang: str) -> DataFrame:
    """Base counts and the two histograms of every row. What several of them need is made in generators, whose output is
    made once; the words first, then the hashes and what remains of the text."""
    rows = docs.select(F.col(id).alias("id"), F.col(lang).alias("lang"), F.coalesce(text, F.lit("")).alias("text"))
    rows = _by_language(rows, common_words(docs, text, lang))
    rows = rows.select("*", F.explode(F.array(F.array_remove(F.split("text", f"{SPACE}+"), ""))).alias("words"))
    rows = rows.select("*", F.inline(F.array(F.struct(
        _hashes(F.col("words")).alias("hashes"), _less(F.col("text"), LOWER_OR_SPACE).alias("rest"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars")))))
    text, words, rest, word_chars = (F.col(c) for c in ("text", "words", "rest", "word_chars"))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return rows.select(
        "id", "lang", F.size(words).cast("long").alias("n_words"), word_chars,
        (F.char_length(rest) - F.char_length(_less(rest, OTHERS["symbols"]))).cast("long").alias("n_symbols"),
        F.transform(F.array(lines), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))[0]
        .alias("n_dup_lines"),
        _repeated_words(words, F.col("hashes")).alias("n_repeat_words"),
        _classes(text, rest, word_chars).alias("classes"), _counted(words, F.col("listed")).alias("common"))


def _shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda s, x: s + x).cast("double")
    return F.transform(counts, lambda x: x / total)


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares; null without one of them."""

    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda x, y: (part(x, y) + part(y, x)) / 2)
    found = F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x), F.lit(0.0)))
    return F.when(p.isNotNull() & q.isNotNull(), found)  # greatest() would pass over a null


def judged(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", least_chars: int = 300,
           least_words: int = 100, char_limit: float = 0.25, word_limit: float = 0.26) -> DataFrame:
    """Every row's id with its base counts, `char_distance` and `word_distance` (null where not judged), `base_failed`
    and `kept`."""
    rows = checkpointed(measured(docs, id, text, lang).select(
        "*", F.when(F.col("word_chars") >= least_chars, _shares(F.col("classes"))).alias("p"),
        F.when(F.col("n_words") >= least_words, _shares(F.col("common"))).alias("q")).drop("classes", "common"))
    mean = [F.avg(F.col(c)[k]).alias(f"{c}{k}") for c, n in
            (("p", N_CLASSES), ("q", N_COMMON + 1)) for k in range(n)]
    references = rows.groupBy("lang").agg(*mean).select(
        F.col("lang").alias("of"), F.array(*[f"p{k}" for k in range(N_CLASSES)]).alias("rp"),
        F.array(*[f"q{k}" for k in range(N_COMMON + 1)]).alias("rq"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (_by_language(rows, references)
            .select(F.col("id").alias(id), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    distance(F.col("p"), F.col("rp")).alias("char_distance"),
                    distance(F.col("q"), F.col("rq")).alias("word_distance"), failed.alias("base_failed"))
            .withColumn("kept", ~F.col("base_failed")
                        & (F.coalesce("char_distance", F.lit(0.0)) <= char_limit)
                        & (F.coalesce("word_distance", F.lit(0.0)) <= word_limit)))
