"""Words, hashes and byte-bounded slices of whole Arrow text columns, computed with numpy."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute

# Text that is worked on at once; a longer document is a slice of its own, whole.
SLICE_BYTES = 1 << 19

U64 = np.uint64


def _table(stop: np.ndarray) -> np.ndarray:
    table = np.ones(256, bool)
    table[stop] = False
    return table


# [^\x20\x09-\x0D]+
PLAIN = _table(np.r_[0x20, 0x09:0x0E])
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALNUM = _table(np.r_[0x00:0x30, 0x3A:0x61, 0x7B:0x80])

FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 32


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Stretches of whole rows whose texts have `limit` bytes at most, or one longer row."""
    ends, at = offsets_of(texts), 0
    while at < len(texts):
        to = int(np.searchsorted(ends, ends[at] + limit, "right")) - 1
        to = min(max(to, at + 1), len(texts))
        yield at, to
        at = to


def offsets_of(texts: pa.Array) -> np.ndarray:
    lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0), dtype=np.int64)
    return np.r_[0, np.cumsum(lengths)]


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column one after another, and where each row begins (one more at the end). Null is empty."""
    texts = pa.concat_arrays([pa.compute.fill_null(texts, "")]).cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


class Words(NamedTuple):
    data: np.ndarray  # bytes of all rows, folded if asked for
    starts: np.ndarray  # byte positions of the words
    ends: np.ndarray
    first: np.ndarray  # number of the first word of each row, one more at the end
    row: np.ndarray  # row of each word


def words_of(texts: pa.Array, kind: np.ndarray = PLAIN, fold: bool = False) -> Words:
    """Maximal runs of word bytes; both kinds of separators are ASCII, so runs never cut a character."""
    data, offsets = bytes_of(texts)
    if fold:
        data = FOLD[data]
    inside = kind[data]
    size = len(data)
    edges = offsets[offsets < size]
    before = np.empty(size, bool)
    before[:1] = False
    before[1:] = inside[:-1]
    before[edges] = False
    after = np.empty(size, bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[edges[edges > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(starts, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, starts, ends, first, row)


@lru_cache(16)
def _lane(lane: int) -> tuple[np.ndarray, int, int]:
    rng = np.random.default_rng(1000 + lane)
    table = rng.integers(1, 1 << 64, 256, U64, endpoint=False)
    factor = int(rng.integers(0, 1 << 61, dtype=U64)) * 8 + 5
    return table, factor, pow(factor, -1, 1 << 64)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, size: int) -> np.ndarray:
    """base ** 0, 1, ... modulo 2 ** 64; one array is kept for each base, as long as the longest text has asked for."""
    known = _POWERS.get(base)
    if known is None or len(known) < size:
        known = np.full(max(size, SLICE_BYTES + 1), base, U64)
        known[0] = 1
        known = _POWERS[base] = np.cumprod(known, dtype=U64)
    return known[:size]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def prefix_sums(data: np.ndarray, lane: int) -> np.ndarray:
    """Sums of a random value for each byte times a power for its place; differences hash any byte string."""
    table, factor, _ = _lane(lane)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(table[data] * powers(factor, len(data)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int) -> np.ndarray:
    """64-bit hashes of the byte strings [start, end): equal for equal strings, wherever they stand."""
    _, _, inverse = _lane(lane)
    return mix((sums[ends] - sums[starts]) * powers(inverse, len(sums))[starts])


def group_hashes(data: np.ndarray, size: int, lane: int) -> np.ndarray:
    """Hash of the `size` bytes at each place, rows disregarded."""
    sums = prefix_sums(data, lane)
    return mix((sums[size:] - sums[:-size]) * powers(_lane(lane)[2], len(data) - size + 1))


def word_hashes(words: Words, lane: int) -> np.ndarray:
    return span_hashes(prefix_sums(words.data, lane), words.starts, words.ends, lane)


def window_hashes(hashes: np.ndarray, size: int, lane: int) -> np.ndarray:
    """Hash of each `size` consecutive word hashes, rows disregarded."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, U64)
    factor = U64(_lane(lane)[1])
    out = hashes[:count].copy()
    for k in range(1, size):
        out *= factor
        out += hashes[k:k + count]
    return mix(out)


def whole_windows(words: Words, size: int) -> np.ndarray:
    """Which of the windows lie in one row."""
    count = len(words.row) - size + 1
    if count <= 0:
        return np.empty(0, bool)
    return words.row[:count] == words.row[size - 1:]


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """Smallest of each `size` consecutive values."""
    count = len(values) - size + 1
    if count <= 0:
        return values[:0]
    out, span = values, 1
    while span * 2 <= size:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[:count], out[size - span:size - span + count])


def covered(starts: np.ndarray, length: int, size: int) -> np.ndarray:
    """Which of `size` places lie in one of the stretches of `length` that begin at `starts`."""
    steps = np.zeros(size + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.subtract.at(steps, np.minimum(starts + length, size), 1)
    return np.cumsum(steps[:-1]) > 0


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the maximal runs of true."""
    edge = np.diff(np.r_[0, flags.astype(np.int8), 0])
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
