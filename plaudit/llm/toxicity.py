"""Toxicity by a learned lexicon, matched with Levenshtein automata.

The lexicon holds words and stems (beginnings of words) that labelled toxic documents use and clean ones do not. It is
learned from at most `per_label` labelled documents of each label: a term must stand out by a G-test, and in
several different neighbourhoods, so that the words of one much copied document do not pass for toxic ones. Every term of
these documents is tested, in Spark; what passes both tests comes to the driver, where the `most_terms` most telling ones
without overlap are taken.

Matching walks the trie of the lexicon and the Levenshtein automaton of all its terms together, as one automaton
whose states are built when first met: most words leave it after a few letters. A term of five letters or more may be
misspelled by one edit, from nine on by two; stems from six letters on by one.

Each hit is weighed by how much its term tells, by how far misspellings of that term can be trusted (learned from the
rest of the sample), and by its context window: inside quotation marks it counts less, beside other
hits or words of address more. The sums feed a logistic calibration.

Null counts as empty and gets the score of a text without hits. Repeated rows get the same answer each. Labels, language
and source are no inputs of a score. If a label is missing, every score is the smoothed share of the other.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaudit.llm.logistic import Logistic
from plaudit.llm.rows import checkpointed, of_sample, packed, sampled, text_of, text_slices, with_columns

EDGES = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum()) + "“”„«»‘’‚‹›¡¿…–—"
OPENING, CLOSING = "\"'“„«‘‚‹”", "\"'”“»’‘›"
QUOTE_REACH = 12
NEAR = 8
#: Words that address somebody, in the languages at hand.
ADDRESS = frozenset("you your you're du dich dein ihr euch tu te toi vous votre usted ustedes eres".split())
STEMS = (4, 5, 6, 7)
_WORD = re.compile(r"\S+")


class Term(NamedTuple):
    text: str
    stem: bool
    weight: float


def edits_allowed(term: Term) -> int:
    size = len(term.text)
    return int(size >= 6) if term.stem else 2 if size >= 9 else int(size >= 5)


class Automaton:
    """The lexicon's trie with the Levenshtein automaton; states are sets of (trie node, edits so far)."""

    def __init__(self, terms: list[Term]) -> None:
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.room = [0]
        for k, term in enumerate(terms):
            node, room = 0, edits_allowed(term)
            self.room[0] = max(self.room[0], room)
            for letter in term.text:
                node = self.children[node].setdefault(letter, len(self.children))
                if node == len(self.children):
                    self.children.append({})
                    self.ends.append([])
                    self.room.append(0)
                self.room[node] = max(self.room[node], room)
            self.ends[node].append(k)
        self.reset()

    def reset(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.members: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.whole: list[tuple] = []
        self.stems: list[tuple] = []
        self.dead = self._state({})
        self.first = self._state({0: 0})

    def __getstate__(self) -> dict:
        return {"terms": self.terms}

    def __setstate__(self, state: dict) -> None:
        self.__init__(state["terms"])

    def _state(self, nodes: dict[int, int]) -> int:
        # A letter of the term that the word leaves out costs an edit.
        todo = list(nodes)
        for node in todo:
            edits = nodes[node] + 1
            for child in self.children[node].values():
                if edits <= self.room[child] and edits < nodes.get(child, 99):
                    nodes[child] = edits
                    todo.append(child)
        members = frozenset(nodes.items())
        state = self.states.get(members)
        if state is None:
            state = self.states[members] = len(self.members)
            self.members.append(members)
            self.steps.append({})
            ends = [(k, edits) for node, edits in sorted(members) for k in self.ends[node]
                    if edits <= edits_allowed(self.terms[k])]
            self.whole.append(tuple(e for e in ends if not self.terms[e[0]].stem))
            self.stems.append(tuple(e for e in ends if self.terms[e[0]].stem))
        return state

    def _step(self, state: int, letter: str) -> int:
        nodes: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.room[node] and edits < nodes.get(node, 99):
                nodes[node] = edits

        for node, edits in self.members[state]:
            reach(node, edits + 1)
            for other, child in self.children[node].items():
                reach(child, edits + (other != letter))
        after = self.steps[state][letter] = self._state(nodes)
        return after

    def match(self, word: str) -> tuple[int, int] | None:
        """The term that fits a word best, and its edits."""
        state, found = self.first, ()
        for letter in word:
            after = self.steps[state].get(letter)
            state = self._step(state, letter) if after is None else after
            if state == self.dead:
                break
            if self.stems[state]:
                found += self.stems[state]
        else:
            found += self.whole[state]
        if not found:
            return None
        return min(found, key=lambda f: (f[1], -self.terms[f[0]].weight, f[0]))


def bare(word: str) -> str:
    return word.strip(EDGES)


class Hit(NamedTuple):
    term: int
    edits: int
    context: float


class Lexicon:
    """Hits of a text with the score of their context windows."""

    def __init__(self, terms: list[Term]) -> None:
        self.automaton = Automaton(terms)
        self.known: dict[str, tuple[int, int] | None] = {}

    def __getstate__(self) -> dict:
        return {"automaton": self.automaton, "known": {}}

    def _match(self, word: str) -> tuple[int, int] | None:
        if word not in self.known:
            if len(self.known) > 200_000:
                self.known.clear()
            if len(self.automaton.members) > 50_000:
                self.automaton.reset()
            self.known[word] = self.automaton.match(word)
        return self.known[word]

    def hits(self, text: str | None) -> tuple[list[Hit], int]:
        words = _WORD.findall((text or "").lower())
        matched = {}
        for word in set(words):
            if (found := self._match(bare(word))) is not None:
                matched[word] = found
        if not matched:
            return [], len(words)
        places = [k for k, word in enumerate(words) if word in matched]
        out = []
        for n, k in enumerate(places):
            context = 1.0
            before, after = words[max(0, k - QUOTE_REACH):k + 1], words[k:k + QUOTE_REACH + 1]
            if quoted(before, after):
                context *= 0.35
            if (n and k - places[n - 1] <= NEAR) or (n + 1 < len(places) and places[n + 1] - k <= NEAR):
                context *= 1.25
            if any(bare(w) in ADDRESS for w in words[max(0, k - NEAR):k + NEAR + 1]):
                context *= 1.25
            out.append(Hit(*matched[words[k]], context))
        return out, len(words)


def quoted(before: list[str], after: list[str]) -> bool:
    """Whether a quotation opens before the last word of `before` and closes from the first word of `after` on."""
    for word in reversed(before):
        if word[0] in OPENING:
            break
        if word is not before[-1] and word.rstrip(".,;:!?")[-1:] in tuple(CLOSING):
            return False
    else:
        return False
    for k, word in enumerate(after):
        if word.rstrip(".,;:!?")[-1:] in tuple(CLOSING) and (k or len(word) > 1):
            return True
        if k and word[0] in OPENING:
            return False
    return False


def summed(hits: list[Hit]) -> dict[tuple[int, int], tuple[float, float]]:
    """Of all hits of a text, by term and edits: the sum of their contexts and the largest."""
    out: dict[tuple[int, int], tuple[float, float]] = {}
    for h in hits:
        total, most = out.get((h.term, h.edits), (0.0, 0.0))
        out[h.term, h.edits] = total + h.context, max(most, h.context)
    return out


class Toxicity:
    def __init__(self, lexicon: Lexicon, trust: dict[tuple[int, int], float], calibrated: Logistic | None) -> None:
        self.lexicon, self.trust, self.calibrated = lexicon, trust, calibrated

    def features(self, text: str | None) -> list[float]:
        return self.weighed(summed(self.lexicon.hits(text)[0]))

    def weighed(self, contexts: dict[tuple[int, int], tuple[float, float]]) -> list[float]:
        total = largest = 0.0
        for (term, edits), (sum_, most) in contexts.items():
            weight = self.lexicon.automaton.terms[term].weight * (self.trust.get((term, edits), TRUST) if edits else 1.0)
            total, largest = total + weight * sum_, max(largest, weight * most)
        return [math.log1p(total), largest]

    def scores(self, texts: Iterable[str | None]) -> np.ndarray:
        return self.calibrated(np.array([self.features(t) for t in texts], float).reshape(-1, 2))


TRUST = 0.6  # of a misspelling of which nothing is known
LEAST_PLACES = 3


def _terms_of(word: str) -> list[str]:
    """The word itself and its stems, which end with a star."""
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) >= n)]


def _counted(text: str, label: str):
    """Documents by term and label, summed for each slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text):
            counts = (Counter(), Counter())
            for t, y in zip(text_of(batch, text).to_pylist(),
                            pa.compute.struct_field(batch.column("doc"), label).to_pylist(), strict=True):
                words = set(map(bare, _WORD.findall((t or "").lower()))) - {""}
                counts[y].update({term for word in words if len(word) < 40 for term in _terms_of(word)})
            for y in (0, 1):
                yield pa.RecordBatch.from_arrays([
                    pa.array(list(counts[y]), pa.string()), pa.array([y] * len(counts[y]), pa.int32()),
                    pa.array(list(counts[y].values()), pa.int64())], ["term", "label", "n"])

    return run


def _placed(text: str):
    """Where words stand: each with its neighbours."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text):
            found = set()
            for t in text_of(batch, text).to_pylist():
                words = [bare(w) for w in _WORD.findall((t or "").lower())]
                found.update((word, " ".join(words[max(0, k - 1):k] + words[k + 1:k + 2]))
                             for k, word in enumerate(words) if word)
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.string()) for i in (0, 1)],
                                             ["word", "place"])

    return run


def _spread(rows: DataFrame, text: str) -> DataFrame:
    """(term, places, words): of each term the different neighbourhoods and the different words. They are counted by word
    first, so a word's terms do not multiply its neighbourhoods."""
    by_word = rows.mapInArrow(_placed(text), "word string, place string").distinct().groupBy("word").agg(
        F.count("*").alias("places"))
    stems = [F.when(F.length("word") >= n, F.concat(F.substring("word", 1, n), F.lit("*"))) for n in STEMS]
    return (by_word.select(F.explode(F.array(F.col("word"), *stems)).alias("term"), "places").dropna()
            .groupBy("term").agg(F.sum("places").alias("places"), F.count("*").alias("words")))


def _g_test(a: Column, b: Column, toxic: int, clean: int) -> Column:
    """Evidence that a term in a toxic and b clean documents prefers toxic ones; 0 if it does not."""
    share = toxic / (toxic + clean)
    both = a + b
    rare = F.when(b > 0, b * F.log(b / (both * (1 - share)))).otherwise(0.0)
    return F.when(a > both * share, 2 * (a * F.log(a / (both * share)) + rare)).otherwise(0.0)


def choose(counts: dict[str, tuple[int, int]], toxic: int, clean: int, most: int) -> list[Term]:
    """At most `most` terms without overlap, the telling ones first; of a stem and a word that tell the same the word is
    taken."""
    told = {}
    for term, (a, b) in counts.items():
        ratio = math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1))
        if ratio > 2.0:
            told[term] = a * ratio, ratio
    kept: list[Term] = []
    for term in sorted(told, key=lambda t: (-round(told[t][0], 6), t.endswith("*"), -len(t), t)):
        if len(kept) >= most:
            break
        text, stem = term.rstrip("*"), term.endswith("*")
        if not any(text.startswith(k.text) if k.stem else stem and k.text.startswith(text) for k in kept) \
                and not any(stem and k.stem and k.text.startswith(text) for k in kept):
            kept.append(Term(text, stem, told[term][1]))
    return kept


def fitted(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
           per_label: int = 20_000, most_terms: int = 1000) -> Toxicity:
    """`labels` has id and label 0 or 1; its rows decide what is learned from."""
    context = docs.sparkSession.sparkContext
    sample = sampled(labels.filter(F.col(label).isin(0, 1)), label, id, per_label)
    rows = packed(of_sample(docs.select(id, text), sample, id), [id, label, text])
    # Three quarters of the sample give the lexicon, the last one the trust and the calibration.
    half = (F.pmod(F.xxhash64(F.lit("half"), F.col("doc").getField(id)), F.lit(4)) == 0).cast("int")
    y = F.col("doc").getField(label)
    totals = {r["y"]: r["n"] for r in rows.filter(half == 0).groupBy(y.alias("y")).agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    terms: list[Term] = []
    if toxic and clean:
        counts = checkpointed(
            rows.filter(half == 0).mapInArrow(_counted(text, label), "term string, label int, n long")
            .groupBy("term").agg(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("a"),
                                 F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("b"))
            .filter((F.col("a") >= LEAST_PLACES) & (F.col("a") * clean > 7 * F.col("b") * toxic)))
        least = 6 + 2 * math.log(max(1, counts.count()))  # the more candidates, the more of them stand out by chance
        telling = _g_test(F.col("a"), F.col("b"), toxic, clean) >= least
        # Not the much copied: documents are counted as at most the neighbourhoods.
        found = (counts.filter(telling).join(_spread(rows.filter((half == 0) & (y == 1)), text), "term")
                 .filter((F.col("places") >= LEAST_PLACES)
                         & (~F.col("term").endswith("*") | (F.col("words") >= LEAST_PLACES)))
                 .select("term", F.least("a", "places").alias("a"), "b").filter(telling))
        terms = choose({r["term"]: (r["a"], r["b"]) for r in found.collect()}, toxic, clean, most_terms)
    lexicon = Lexicon(terms)
    shared = context.broadcast(lexicon)
    names = ("term", "edits", "total", "most")
    out = pa.list_(pa.struct(list(zip(names, (pa.int32(), pa.int32(), pa.float64(), pa.float64()), strict=True))))

    def work(batch: pa.RecordBatch, texts: pa.Array) -> dict[str, pa.Array]:
        return {"told": pa.array([[dict(zip(names, (*key, *contexts), strict=True)) for key, contexts in
                                   summed(shared.value.hits(t)[0]).items()] for t in texts.to_pylist()], out)}

    judged = checkpointed(with_columns(
        rows.filter(half == 1), "told array<struct<term: int, edits: int, total: double, most: double>>", work, text)
        .select(y.cast("int").alias("y"), "told"))
    misspelt = judged.filter(F.forall("told", lambda t: t.edits > 0)).select("y", F.explode("told").alias("t"))
    trust = {(r["term"], r["edits"]): (3 + r["ones"]) / (5 + r["n"]) for r in misspelt.groupBy("t.term", "t.edits").agg(
        F.sum("y").alias("ones"), F.count("*").alias("n")).collect()}
    model = Toxicity(lexicon, trust, None)
    learned = context.broadcast(model)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [learned.value.weighed({(t["term"], t["edits"]): (t["total"], t["most"]) for t in told})
                     for told in batch.column("told").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(found, pa.list_(pa.float64()))],
                                             ["y", "features"])

    # Two numbers of each document of a quarter of the sample.
    found = judged.mapInArrow(weigh, "y int, features array<double>").collect()
    model.calibrated = Logistic(np.array([r["features"] for r in found], float).reshape(-1, 2),
                                np.array([r["y"] for r in found]))
    return model


def scored(docs: DataFrame, model: Toxicity, id: str = "doc_id", text: str = "text",
           carry: list[str] | None = None) -> DataFrame:
    """Every row of `docs` as `doc` with its score from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch, texts: pa.Array) -> dict[str, pa.Array]:
        return {"score": pa.array(shared.value.scores(texts.to_pylist()), pa.float64())}

    return with_columns(packed(docs, [id, text, *(carry or [])]), "score double", work, text)
