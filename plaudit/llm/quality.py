"""Quality by compression: which of two dictionaries, from good or from bad text, makes a text smaller.

The model learns from at most `per_label` labelled documents of each label, those with the smallest hash of the id; one half
of them gives the dictionaries, the other half the calibration, so that no text is judged by a dictionary that holds it. The
dictionaries are trained on pieces from all over these texts: all pieces of a label up to `label_bytes` (16 MB), of more
the ones with the smallest hash of id and place. A text is compressed in pieces, whole, with either dictionary; the difference of the
sizes, divided by their sum, is all that the logistic calibration sees.

Null counts as empty; an empty text gets the calibrated score of its (zero) difference. Repeated rows get the same
answer each. If a label is missing, every score is the smoothed share of the other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaudit.llm.logistic import Logistic
from plaudit.llm.rows import of_sample, packed, sampled, text_of, text_slices, with_columns

PIECE = 2048
DICTIONARY = 112_640
LEVEL = 3


def pieces(data: bytes, size: int = PIECE) -> list[bytes]:
    return [data[at:at + size] for at in range(0, len(data), size)]


def dictionary(samples: list[bytes], size: int = DICTIONARY) -> bytes:
    """A trained dictionary; too little text for training is taken as it is."""
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


class Compression:
    """Difference of a text's sizes under two dictionaries."""

    def __init__(self, good: bytes, bad: bytes) -> None:
        self.parts = good, bad
        self.own = None

    def __getstate__(self) -> dict:
        return {"parts": self.parts, "own": None}

    def difference(self, text: str | None) -> float:
        if self.own is None:
            self.own = [zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, dict_data=zstandard.
                                                 ZstdCompressionDict(p) if p else None) for p in self.parts]
        data = (text or "").encode()
        if not data:
            return 0.0
        good, bad = (sum(len(c.compress(p)) for p in pieces(data)) for c in self.own)
        return (bad - good) / (bad + good)


class Quality:
    def __init__(self, compression: Compression, calibrated: Logistic) -> None:
        self.compression, self.calibrated = compression, calibrated

    def scores(self, texts: list) -> np.ndarray:
        return self.calibrated(np.array([self.compression.difference(t) for t in texts], float).reshape(-1, 1))


def _pieces(rows: DataFrame, id: str, text: str, label: str, most: int, totals: dict[int, int | None]) -> DataFrame:
    """(label, place, piece): of all pieces of the texts those whose hash of id and place is below the share that is wanted,
    and somewhat more."""
    schema = pa.schema([("label", pa.int32()), ("place", pa.int64()), ("piece", pa.binary())])

    def cut(batches):
        for batch in text_slices(batches, text):
            for key, y, t in zip(*(pa.compute.struct_field(batch.column("doc"), n).to_pylist() for n in (id, label)),
                                 text_of(batch, text).to_pylist(), strict=True):
                wanted = (1.1 * most + 100) / max(1, totals[y] or 0)
                found = []
                for k, piece in enumerate(pieces((t or "").encode())):
                    place = xxhash.xxh64_intdigest(f"{k} {key}")
                    if place < wanted * 2.0**64:
                        found.append({"label": y, "place": place >> 1, "piece": piece})
                yield pa.RecordBatch.from_pylist(found, schema)

    return rows.mapInArrow(cut, "label int, place long, piece binary")


def fitted(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality",
           per_label: int = 8000, label_bytes: int = 16 << 20) -> Quality:
    """`labels` has id and label 0 or 1; its rows decide what is learned from. `label_bytes` bounds the text of each label
    that the dictionaries are trained on."""
    sample = sampled(labels.filter(F.col(label).isin(0, 1)), label, id, per_label)
    rows = packed(of_sample(docs.select(id, text), sample, id), [id, label, text])
    half = F.pmod(F.xxhash64(F.lit("half"), F.col("doc").getField(id)), F.lit(2))
    most = max(1, label_bytes // PIECE)
    y, size = F.col("doc").getField(label), F.octet_length(F.col("doc").getField(text))
    totals = {r["y"]: r["n"] for r in rows.filter(half == 0).groupBy(y.alias("y")).agg(
        F.sum(F.ceil(size / PIECE)).alias("n")).collect()}
    found = _pieces(rows.filter(half == 0), id, text, label, most, totals).collect()  # about `most` of each label
    built = []
    for value in (1, 0):
        samples = sorted((r["place"], bytes(r["piece"])) for r in found if r["label"] == value)[:most]
        built.append(dictionary([piece for _, piece in samples]) if samples else b"")
    compression = Compression(*built)
    shared = docs.sparkSession.sparkContext.broadcast(compression)

    def work(batch: pa.RecordBatch, texts: pa.Array) -> dict[str, pa.Array]:
        return {"apart": pa.array([shared.value.difference(t) for t in texts.to_pylist()], pa.float64())}

    judged = with_columns(rows.filter(half == 1), "apart double", work, text).select(
        F.col("doc").getField(label).alias("label"), "apart").collect()  # numbers of half the sample
    features = np.array([r["apart"] for r in judged], float).reshape(-1, 1)
    return Quality(compression, Logistic(features, np.array([r["label"] for r in judged])))


def scored(docs: DataFrame, model: Quality, id: str = "doc_id", text: str = "text",
           carry: list[str] | None = None) -> DataFrame:
    """Every row of `docs` as `doc` with its score from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch, texts: pa.Array) -> dict[str, pa.Array]:
        return {"score": pa.array(shared.value.scores(texts.to_pylist()), pa.float64())}

    return with_columns(packed(docs, [id, text, *(carry or [])]), "score double", work, text)
