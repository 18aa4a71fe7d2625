"""Token counts by a public tokenizer, in Arrow batches balanced by bytes.

Only lengths leave the tasks. A long text is cut where a single space stands between two other characters; a piece
of the vocabulary has the space mark at its beginning only, so no merge crosses such a place, and the space itself
comes back as the mark that the library puts before every text. The library's model is checked for that rule when it is
loaded; text without such a place stays whole.

Null counts as empty. Repeated rows are counted each, ids are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from plaudit.llm.rows import packed, with_columns

MARK = "▁"
BATCH_BYTES = 1 << 16
PIECE_CHARS = 1 << 14


@lru_cache(2)
def _model(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    inner = any(MARK in p.lstrip(MARK) for p in pieces)
    # The mark before a text, runs of spaces kept as they are, nothing but the space turned into the mark.
    plain = [model.encode("a  b ", out_type=str), model.encode("a", out_type=str)[0][:1]]
    return model, not inner and "".join(plain[0]) == f"{MARK}a{MARK}{MARK}b{MARK}" and plain[1] == MARK


_BETWEEN = re.compile(r"(?<=[!-~]) (?=[!-~])")


def cut(text: str, limit: int = PIECE_CHARS) -> list[str]:
    """Parts of the text between single spaces with printable ASCII at both sides, each about `limit` long."""
    parts, at = [], 0
    while len(text) - at > limit:
        place = _BETWEEN.search(text, at + limit)
        if place is None:
            break
        parts.append(text[at:place.start()])
        at = place.end()
    return [*parts, text[at:]]


def batches(parts: list[str], limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Stretches of parts with `limit` bytes of UTF-8 at most, or one longer part."""
    at = size = 0
    for k, part in enumerate(parts):
        own = len(part.encode())
        if k > at and size + own > limit:
            yield at, k
            at, size = k, 0
        size += own
    if parts:
        yield at, len(parts)


def counted(docs: DataFrame, model_path: str, id: str = "doc_id", text: str = "text",
            carry: list[str] | None = None) -> DataFrame:
    """Every row of `docs` as `doc` with the bytes and tokens of its whole text."""

    def work(batch: pa.RecordBatch, texts: pa.Array) -> dict[str, pa.Array]:
        model, splits = _model(model_path)
        whole = [t or "" for t in texts.to_pylist()]
        n_bytes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0), np.int64)
        parts, owner = [], []
        for i, t in enumerate(whole):
            own = cut(t) if splits and len(t) > PIECE_CHARS else [t]
            parts += own
            owner += [i] * len(own)
        n_tokens = np.zeros(len(whole), np.int64)
        for at, to in batches(parts):
            lengths = [len(x) for x in model.encode(parts[at:to], num_threads=1)]
            np.add.at(n_tokens, owner[at:to], lengths)
        return {"n_bytes": pa.array(n_bytes), "n_tokens": pa.array(n_tokens)}

    return with_columns(packed(docs, [id, text, *(carry or [])]), "n_bytes long, n_tokens long", work, text)
