"""Repeated passages of words, found by a count-min prefilter and an exact second pass.

Pass 1 counts, for every document, the anchors of its word windows in a count-min sketch. A window's anchor is
the smallest hash among its inner word groups: equal windows have equal anchors, neighbours mostly share one, and so
the sketch holds a quarter of the keys and its estimate for a window is still never too low.

Pass 2 groups exactly, by 96 bits of hash, those windows whose estimate is two documents or more, and finds the smallest
id of each group. A window estimated in fewer than `hot` documents is one group, which the estimate bounds. The
smallest id of the others is found first, reduced in the tasks before the shuffle; each such window is then dealt over `salts`
groups, and the smallest id is put into those of them that have rows.

The sketch has a fixed largest size (`max_bits`). Beyond the input it suits, more windows pass the prefilter and
reach the exact pass, which then shuffles more; the result stays the same.

Null texts have no words. Rows without an id keep all their words and remove none. Rows that share an id never
remove each other's words, but each of them loses what a smaller id has. Columns other than id and text are carried
along in `doc` if asked for.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plaudit.llm.rows import packed, text_of, text_slices, with_columns
from plaudit.llm.sketch import sketched
from plaudit.llm.text import covered, sliding_min, whole_windows, window_hashes, word_hashes, words_of

def _windows(texts: pa.Array, window: int):
    """Words, which windows lie in one row, their 64-bit hashes, and their cells' source: the anchors."""
    words = words_of(texts)
    hashes = word_hashes(words, 0)
    part = (window + 1) // 2
    anchors = sliding_min(window_hashes(hashes, part, 2), window - part + 1)
    return words, whole_windows(words, window), window_hashes(hashes, window, 0), anchors


def _anchors(text: str, window: int):
    """Anchors of the windows of a slice of rows, once for each row."""

    def keys(batch: pa.RecordBatch) -> np.ndarray:
        words, whole, _, anchors = _windows(text_of(batch, text), window)
        rows, anchors = words.row[:len(whole)][whole], anchors[whole]
        for order in (None, np.lexsort):  # neighbours first, then all
            if order is not None:
                order = order((anchors, rows))
                rows, anchors = rows[order], anchors[order]
            new = np.r_[True, (anchors[1:] != anchors[:-1]) | (rows[1:] != rows[:-1])][:len(rows)]
            rows, anchors = rows[new], anchors[new]
        return anchors

    return keys


def _candidates(id: str, text: str, window: int, sketch):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text):
            words, whole, keys, anchors = _windows(text_of(batch, text), window)
            chosen = np.flatnonzero(whole)
            chosen = chosen[sketch.value.repeated(anchors[chosen])]
            if not len(chosen):
                continue
            rows, keys = words.row[chosen], keys[chosen]
            order = np.lexsort((keys, rows))
            new = np.r_[True, (np.diff(rows[order]) != 0) | (keys[order][1:] != keys[order][:-1])]
            chosen = chosen[order[new]]
            second = window_hashes(word_hashes(words, 1), window, 1)
            ids = pa.compute.struct_field(batch.column("doc"), id).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([
                pa.array(keys[order[new]].view(np.int64)),
                pa.array(second[chosen].astype(np.uint32).view(np.int32)),
                ids.take(pa.array(words.row[chosen])),
                pa.array(sketch.value.frequent(anchors[chosen])),
            ], ["key", "more", "id", "often"])

    return run


def removed_windows(docs: DataFrame, id: str, text: str, window: int = 13, hot: int = 10_000,
                    max_bits: int = 27, salts: int = 64) -> DataFrame:
    """For each id the keys of its windows that also start in a document with a smaller id."""
    spark = docs.sparkSession
    rows = packed(docs.filter(F.col(id).isNotNull()), [id, text])
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    # An anchor comes with about 26 bytes of text.
    sketch = spark.sparkContext.broadcast(sketched(rows, text, _anchors(text, window), size / 26, max_bits, hot))
    found = rows.mapInArrow(_candidates(id, text, window, sketch), "key long, more int, id long, often boolean")
    salted = found.withColumn("salt", F.when(F.col("often"), F.pmod(F.xxhash64("id"), F.lit(salts))).otherwise(0))
    least = (salted.filter("often").groupBy("key", "more")
             .agg(F.min("id").alias("id"), F.collect_set("salt").alias("salts"), F.count("*").alias("n"))
             .filter("n > 1").select("key", "more", "id", F.explode("salts").alias("salt")))
    group = Window.partitionBy("key", "more", "salt")
    later = (salted.select("key", "more", "id", "salt").union(least)
             .withColumn("least", F.min("id").over(group)).filter("id > least"))
    return later.groupBy("id").agg(F.collect_list("key").alias("keys"))


def without_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = 13,
                    carry: list[str] | None = None, hot: int = 10_000, max_bits: int = 27) -> DataFrame:
    """Every row of `docs` as `doc` with its number of words, how many were removed, and the kept words.

    A word goes if a window of `window` words that covers it also starts in a document with a smaller id.
    """
    keys = removed_windows(docs, id, text, window, hot, max_bits).withColumnRenamed("id", "_id")
    rows = packed(docs, [id, text, *(carry or [])])
    joined = rows.join(keys, F.col("doc").getField(id) == F.col("_id"), "left").select("doc", "keys")

    def work(batch: pa.RecordBatch, texts: pa.Array) -> dict[str, pa.Array]:
        words = words_of(texts)
        keys = batch.column("keys")
        n_words = np.diff(words.first)
        n_removed = np.zeros(len(texts), np.int64)
        kept = []
        hashes = None
        if keys.null_count < len(keys):
            hashes = window_hashes(word_hashes(words, 0), window, 0).view(np.int64)
        for i, whole in enumerate(texts):
            parts = (whole.as_py() or "").encode().split()
            if keys[i].is_valid and n_words[i] >= window:
                a, b = words.first[i], words.first[i + 1]
                at = np.flatnonzero(np.isin(hashes[a:b - window + 1], keys[i].values.to_numpy()))
                gone = covered(at, window, b - a)
                n_removed[i] = gone.sum()
                parts = compress(parts, ~gone)
            kept.append(b" ".join(parts).decode())
        return {"n_words": pa.array(n_words), "n_removed": pa.array(n_removed), "kept_text": pa.array(kept, pa.string())}

    return with_columns(joined, "n_words long, n_removed long, kept_text string", work, text).drop("keys")
