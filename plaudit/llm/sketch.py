"""Count-min sketches of 64-bit keys, counted in the tasks, merged by block of cells, and handed out as bits.

A key's estimate is the smallest of its cells and never too low. Each task sends the cells that it has met, as
compressed steps and counts; a block of cells is summed in one task. What comes to the driver is two bits for each cell, whatever
the input: whether its count is two or more, and whether it is `often` or more.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from plaudit.llm.rows import text_slices
from plaudit.llm.text import U64, mix

DEPTH = 2  # rows of the sketch
BLOCK_BITS = 20
MERGERS = 64  # tasks that sum blocks; each holds a few of them, of four bytes a cell
MOST = (1 << 32) - 1
SEND = 3_000_000  # cells that a task holds before it sends them


def _cells(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    """A cell in each row of the sketch; rows stand one after another."""
    mask, keys = U64((1 << bits) - 1), mix(keys)
    return [((keys >> U64(32 * k)) & mask).astype(np.int64) + (k << bits) for k in range(DEPTH)]


def _block_bits(bits: int) -> int:
    return min(BLOCK_BITS, bits)


def _parts(text: str, keys: Callable[[pa.RecordBatch], np.ndarray], bits: int):
    """Counts by cell as this task sees them: blocks of cells, steps between cells, counts."""

    def send(found: list[np.ndarray]) -> pa.RecordBatch:
        pack = zstandard.ZstdCompressor(level=1)
        cells, counts = np.unique(np.concatenate(found), return_counts=True)
        bounds = np.flatnonzero(np.diff(cells >> _block_bits(bits), prepend=-1))
        rows = []
        for a, b in zip(bounds, [*bounds[1:], len(cells)], strict=True):
            block = int(cells[a]) >> _block_bits(bits)
            steps = np.diff(cells[a:b], prepend=block << _block_bits(bits)).astype(np.uint32)
            rows.append((block, pack.compress(steps.tobytes()), pack.compress(counts[a:b].astype(np.uint32).tobytes())))
        return pa.RecordBatch.from_pylist([dict(zip(("block", "steps", "counts"), r, strict=True)) for r in rows],
                                          pa.schema([("block", pa.int32()), ("steps", pa.binary()),
                                                     ("counts", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for batch in text_slices(batches, text):
            found += _cells(keys(batch), bits)
            size += sum(map(len, found[-DEPTH:]))
            if size > SEND:
                yield send(found)
                found, size = [], 0
        if size:
            yield send(found)

    return run


def _merged(bits: int, often: int):
    """Sums the parts of each block; bits of the cells with two or more, and with `often` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, sums = zstandard.ZstdDecompressor(), {}
        for batch in batches:
            for part in batch.to_pylist():
                total = sums.setdefault(part["block"], np.zeros(1 << _block_bits(bits), np.uint32))
                at = np.cumsum(np.frombuffer(unpack.decompress(part["steps"]), np.uint32))
                counts = np.frombuffer(unpack.decompress(part["counts"]), np.uint32)
                total[at] = np.minimum(total[at].astype(np.int64) + counts, MOST)
        pack = zstandard.ZstdCompressor(level=1)
        for block, total in sums.items():
            yield pa.RecordBatch.from_pylist([{"block": block, **{
                name: pack.compress(np.packbits(total >= least, bitorder="little").tobytes())
                for name, least in (("twice", 2), ("often", often))}}],
                pa.schema([("block", pa.int32()), ("twice", pa.binary()), ("often", pa.binary())]))

    return run


class Sketch:
    """Which cells hold two or more, and which hold many; a bit each."""

    def __init__(self, bits: int, blocks: list) -> None:
        self.bits = bits
        unpack, size = zstandard.ZstdDecompressor(), (1 << _block_bits(bits)) // 8
        self.twice, self.often = (np.zeros(DEPTH << bits >> 3, np.uint8) for _ in range(2))
        for block in blocks:
            for whole, part in ((self.twice, block["twice"]), (self.often, block["often"])):
                whole[block["block"] * size:][:size] = np.frombuffer(unpack.decompress(part), np.uint8)
        if not self.often.any():
            self.often = None

    def _all(self, table: np.ndarray | None, keys: np.ndarray) -> np.ndarray:
        flags = np.full(len(keys), table is not None)
        if table is None:
            return flags
        for cells in _cells(keys, self.bits):
            flags &= (table[cells >> 3] >> (cells & 7).astype(np.uint8) & 1).astype(bool)
        return flags

    def repeated(self, keys: np.ndarray) -> np.ndarray:
        return self._all(self.twice, keys)

    def frequent(self, keys: np.ndarray) -> np.ndarray:
        return self._all(self.often, keys)


def sketched(rows: DataFrame, text: str, keys: Callable[[pa.RecordBatch], np.ndarray], expected: float,
             max_bits: int, often: int = 1 << 31) -> Sketch:
    """The sketch of all keys of the rows, with four cells in each of its rows for each key expected."""
    bits = min(max_bits, max(16, int(4 * expected).bit_length()))
    parts = rows.mapInArrow(_parts(text, keys, bits), "block int, steps binary, counts binary")
    blocks = parts.repartition(min(MERGERS, DEPTH << bits >> _block_bits(bits)), "block").mapInArrow(
        _merged(bits, often), "block int, twice binary, often binary").collect()  # two bits a cell at most
    return Sketch(bits, blocks)
