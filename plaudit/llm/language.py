"""Language of a text by rank-order profiles of its n-grams.

A profile is the list of the most frequent letter n-grams (one to three letters, word edges included), most frequent
first, ties by code point. A document is compared with each language's profile by the out-of-place distance: for each of
its n-grams how far its rank lies from the rank in the profile, or the profile's length where it is missing.

Profiles are learned from at most `per_language` labelled documents of each language, those with the smallest hash of
the id. Null texts and texts without a letter are `und` with score 0. Repeated rows get the same answer each; nothing but the
text is looked at. Without any labelled text all texts are `und`. Of equal distances the smaller name wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plaudit.llm.rows import of_sample, packed, sampled, text_of, text_slices, with_columns

UNKNOWN = "und"
RANKS = 300
SHARPNESS = 25.0


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """N-gram codes of a text and how often each occurs. The edge of a word is code 1, a letter its code point."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.r_[np.uint64(1), np.where(_letters()[codes], codes, 1).astype(np.uint64), np.uint64(1)]
    codes = codes[np.r_[True, (codes[1:] != 1) | (codes[:-1] != 1)]]
    if len(codes) < 3:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    two = codes[:-1] << np.uint64(21) | codes[1:]
    three = (two[:-1] << np.uint64(21) | codes[2:])[codes[1:-1] != 1]
    return np.unique(np.concatenate([codes[codes != 1], two, three]), return_counts=True)


def ranked(codes: np.ndarray, counts: np.ndarray, ranks: int = RANKS) -> np.ndarray:
    if len(counts) > ranks:  # the order of the others does not matter
        least = np.partition(counts, len(counts) - ranks)[len(counts) - ranks]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.lexsort((codes, -counts))][:ranks]


class Profiles:
    def __init__(self, found: dict[str, list[int]], ranks: int = RANKS) -> None:
        self.names, self.ranks = sorted(found), ranks
        self.codes, self.places = [], []
        for name in self.names:
            codes = np.array(found[name], np.uint64)
            order = np.argsort(codes)
            self.codes.append(codes[order])
            self.places.append(order)

    def distances(self, document: np.ndarray) -> np.ndarray:
        """Mean out-of-place distance to each language, from 0 to 1."""
        own = np.arange(len(document))
        out = []
        for codes, places in zip(self.codes, self.places, strict=True):
            at = np.minimum(np.searchsorted(codes, document), len(codes) - 1)
            off = np.where(codes[at] == document, np.minimum(np.abs(places[at] - own), self.ranks), self.ranks)
            out.append(off.mean() / self.ranks)
        return np.array(out)

    def best(self, text: str | None) -> tuple[str, float]:
        document = ranked(*grams(text), self.ranks)
        if not len(document) or not self.names:
            return UNKNOWN, 0.0
        far = self.distances(document)
        near = np.exp(-SHARPNESS * (far - far.min()))
        k = int(np.argmin(far))
        return self.names[k], float(near[k] / near.sum())


def fitted(labelled: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang",
           per_language: int = 2000, ranks: int = RANKS) -> Profiles:
    """Profiles from labelled documents; `per_language` bounds what is read of each language."""
    sample = sampled(labelled.filter(F.col(text).isNotNull()), lang, id, per_language)
    rows = packed(of_sample(labelled.select(id, text), sample, id), [lang, text])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text):
            names = np.array(pa.compute.struct_field(batch.column("doc"), lang).to_pylist(), object)
            texts = np.array(text_of(batch, text).to_pylist(), object)
            for name in set(names):
                codes, counts = grams("\n".join(texts[names == name]))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(codes), pa.string()),
                                                  pa.array(codes.view(np.int64)), pa.array(counts, pa.int64())],
                                                 ["lang", "code", "n"])

    counts = rows.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    top = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= ranks)
    found: dict[str, list[int]] = {}
    for row in top.orderBy("lang", "rank").collect():  # `ranks` rows of each language
        found.setdefault(row["lang"], []).append(row["code"] % (1 << 64))
    return Profiles(found, ranks)


def identified(docs: DataFrame, profiles: Profiles, id: str = "doc_id", text: str = "text",
               carry: list[str] | None = None) -> DataFrame:
    """Every row of `docs` as `doc` with lang_pred and its score from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def work(batch: pa.RecordBatch, texts: pa.Array) -> dict[str, pa.Array]:
        found = [shared.value.best(t) for t in texts.to_pylist()]
        return {"lang_pred": pa.array([f[0] for f in found], pa.string()),
                "score": pa.array([f[1] for f in found], pa.float64())}

    return with_columns(packed(docs, [id, text, *(carry or [])]), "lang_pred string, score double", work, text)
