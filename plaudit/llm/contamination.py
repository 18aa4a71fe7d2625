"""Benchmark passages in documents, by Wu-Manber search over words.

The windows of the benchmark items are the patterns, words are the symbols, and a block is two words (one, where the
pattern is a single word). For each pattern length a shift table says how far the search may move on after a block, a
bucket table lists the patterns that end with a block, and the words of a candidate are compared one by one.
The search starts at every place that the largest shift would reach, all of them at once in numpy.

Items are cut into runs of `run_windows` windows at most, so that a long item is several runs, and the runs are dealt into
blocks of about `block_bytes` of text. One block at a time is broadcast and searched; the hits are written before the next
is broadcast, so that a task holds the tables of one block however large the benchmark is. A benchmark of one block is
searched in the pass that also gives the result.

Null and wordless texts have no words and no hits; items without an id or without words have no windows. Items that share
an id count as one, repeated items are taken once. Repeated documents are judged each; those with one text have the same hits.
A window that stands several times, or in several items, counts for each; there are no ties to break. Texts are searched
whole, however long. No documents give no rows, no items no hits. Other columns are passed on within `doc`, whatever their names.
"""

from __future__ import annotations

import string
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaudit.llm.rows import packed, stored, with_columns
from plaudit.llm.text import ALNUM, FOLD, U64, window_hashes, word_hashes, words_of

TABLE = 1 << 18
#: What words are parted by, after A-Z have been lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACED = np.where(ALNUM[FOLD], FOLD, 32).astype(np.uint8).tobytes()


def words_in(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(SPACED).split()


class Patterns:
    """Shift and bucket tables of all patterns of one length."""

    def __init__(self, length: int, found: dict[tuple[bytes, ...], list[str]]) -> None:
        self.length, self.block = length, min(2, length)
        self.words = [list(p) for p in found]
        self.items = list(found.values())
        flat = pa.array([b" ".join(p).decode("utf-8", "surrogateescape").encode() for p in found], pa.binary())
        words = words_of(flat.cast(pa.string()), ALNUM)
        blocks = window_hashes(word_hashes(words, 0), self.block, 0)
        first = words.first[:-1]
        self.longest = length - self.block + 1
        self.shift = np.full(TABLE, self.longest, np.int64)
        for place in range(length - self.block + 1):
            np.minimum.at(self.shift, (blocks[first + place] & U64(TABLE - 1)).astype(np.int64),
                          length - self.block - place)
        ends = blocks[first + length - self.block]
        self.order = np.argsort(ends, kind="stable")
        self.suffixes = ends[self.order]
        self.prefixes = blocks[first][self.order]

    def candidates(self, blocks: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word places at which a pattern may begin, and the pattern. blocks: hash of the block at each word."""
        lead = self.length - self.block
        n_words = np.diff(first)
        rows = np.flatnonzero(n_words >= self.length)
        lanes = -(-(n_words[rows] - lead - self.block + 1) // self.longest)
        row = np.repeat(rows, lanes)
        step = np.arange(len(row)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        # `at` is the place of the block that would end the pattern.
        at = first[row] + lead + step * self.longest
        stop = np.minimum(at + self.longest, first[row + 1] - self.block + 1)
        hits = []
        while len(at):
            shift = self.shift[(blocks[at] & U64(TABLE - 1)).astype(np.int64)]
            hits.append(at[shift == 0])
            at = at + np.maximum(shift, 1)
            go = at < stop
            at, stop = at[go], stop[go]
        at = np.sort(np.concatenate(hits)) if hits else np.empty(0, np.int64)
        low = np.searchsorted(self.suffixes, blocks[at], "left")
        count = np.searchsorted(self.suffixes, blocks[at], "right") - low
        pattern = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        begin = np.repeat(at, count) - lead
        same = self.prefixes[pattern] == blocks[begin]
        return begin[same], self.order[pattern[same]]


def patterns_of(items: list[tuple[str, str]], window: int) -> list[Patterns]:
    found: dict[int, dict[tuple[bytes, ...], list[str]]] = {}
    for item, text in items:
        words = words_in(text)
        length = min(window, len(words))
        for k in range(len(words) - length + 1 if words else 0):
            owners = found.setdefault(length, {}).setdefault(tuple(words[k:k + length]), [])
            if item not in owners[-1:]:
                owners.append(item)
    return [Patterns(length, group) for length, group in sorted(found.items())]


HIT = "array<struct<item: string, start: int, stop: int>>"
HITS = pa.list_(pa.struct([("item", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))


def _search(patterns, name: str):
    def work(batch: pa.RecordBatch, texts: pa.Array) -> dict[str, pa.Array]:
        words = words_of(texts, ALNUM, fold=True)
        hashes = word_hashes(words, 0)
        places: dict[int, dict[str, list[tuple[int, int]]]] = {}
        split: dict[int, list[bytes]] = {}
        blocks = {size: window_hashes(hashes, size, 0) for size in (1, 2)}
        for group in patterns.value:
            for begin, pattern in zip(*map(np.ndarray.tolist, group.candidates(blocks[group.block], words.first)),
                                      strict=True):
                row = int(words.row[begin])
                if row not in split:
                    split[row] = words_in(texts[row].as_py())
                at = begin - int(words.first[row])
                if split[row][at:at + group.length] == group.words[pattern]:
                    for item in group.items[pattern]:
                        spans = places.setdefault(row, {}).setdefault(item, [])
                        if spans and spans[-1][0] <= at <= spans[-1][1]:
                            spans[-1] = (spans[-1][0], max(spans[-1][1], at + group.length))
                        else:
                            spans.append((at, at + group.length))
        return {name: pa.array([[{"item": item, "start": a, "stop": b} for item, spans in places.get(row, {}).items()
                                 for a, b in spans] for row in range(len(texts))], HITS)}

    return work


def runs_of(items: DataFrame, window: int, run_windows: int) -> DataFrame:
    """(item, text) of runs of words that hold all windows of the items, each window in one of them."""
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    words = items.select("item", F.array_remove(F.split(lower, BETWEEN), "").alias("words"))
    places = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)), F.lit(run_windows))
    return words.select("item", "words", F.explode(places).alias("at")).select("item", F.array_join(
        F.slice("words", F.col("at") + 1, run_windows + window - 1), " ").alias("text")).where("text <> ''").distinct()


def searched(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id",
             item_text: str = "text", window: int = 13, carry: list[str] | None = None,
             block_bytes: int = 8 << 20, run_windows: int = 4096) -> DataFrame:
    """Every row of `docs` as `doc` with n_words, n_hit, n_items, items (sorted ids) and `hits`: by item, the stretches
    of words that its windows cover."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item).cast("string").alias("item"), F.col(item_text).alias("text")).dropna()
    runs = stored(runs_of(items, window, run_windows), "benchmark-runs")
    size = runs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    block = F.pmod(F.xxhash64("item", "text"), F.lit(max(1, -(-size // block_bytes))))
    blocks = [r.block for r in runs.select(block.alias("block")).distinct().orderBy("block").collect()]
    rows = packed(docs, [id, text, *(carry or [])])

    def found_in(rows: DataFrame, number: int) -> tuple[DataFrame, Broadcast]:
        chosen = sorted((r["item"], r["text"]) for r in runs.filter(block == number).collect())  # about block_bytes
        patterns = spark.sparkContext.broadcast(patterns_of(chosen, window))
        return with_columns(rows, f"found {HIT}", _search(patterns, "found"), text), patterns

    if not blocks:
        rows = rows.withColumn("found", F.array().cast(HIT))
    elif len(blocks) == 1:
        rows, _ = found_in(rows, blocks[0])
    else:
        own = F.col("doc").getField(text)
        keyed = rows.withColumns({"k1": F.xxhash64(own), "k2": F.xxhash64(F.lit(1), own)})
        hits = []
        for number in blocks:
            found, patterns = found_in(keyed, number)
            hits.append(stored(found.select("k1", "k2", F.explode("found").alias("hit")).distinct(), "hits"))
            patterns.unpersist()
        of_text = reduce(DataFrame.union, hits).distinct().groupBy("k1", "k2").agg(F.collect_list("hit").alias("found"))
        rows = keyed.join(of_text, ["k1", "k2"], "left").select(
            "doc", F.coalesce("found", F.array().cast(HIT)).alias("found"))

    def summed(batch: pa.RecordBatch, texts: pa.Array) -> dict[str, pa.Array]:
        n_words = np.diff(words_of(texts, ALNUM, fold=True).first)
        n_hit, owners, hits = np.zeros(len(texts), np.int64), [], []
        for i, own in enumerate(batch.column("found").to_pylist()):
            if own:
                flags = np.zeros(n_words[i], bool)
                for h in own:
                    flags[h["start"]:h["stop"]] = True
                n_hit[i] = flags.sum()
            hits.append(own)
            owners.append(sorted({h["item"] for h in own}))
        return {"n_words": pa.array(n_words), "n_hit": pa.array(n_hit), "items": pa.array(owners, pa.list_(pa.string())),
                "n_items": pa.array([len(x) for x in owners], pa.int64()), "hits": pa.array(hits, HITS)}

    return with_columns(rows, f"n_words long, n_hit long, items array<string>, n_items long, hits {HIT}",
                        summed, text).drop("found")
