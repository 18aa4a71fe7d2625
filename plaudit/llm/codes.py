"""Vectors as short codes: a codebook for each of several equal parts, found by Lloyd's rounds over exact integers.

Each component becomes floor(scale * x). A round assigns every part to its nearest entry and moves each entry to the
floored mean of its parts. A part remembers its entry and the exact distance to it. As long as that entry has not moved, no
entry that stayed where it was can have become nearer, so the part is compared with the entries that moved only; the others
rescan the whole codebook. Between equal distances the lower index wins in both ways, so the codes are those of full scans.

Spark holds the vectors with their entries and distances, one persisted step a round, which a lost executor makes again from
the step before (a handful of maps, no shuffle). Only sums and counts for each entry come to the driver: entries times
components, whatever the number of vectors.

Null vectors and those with a null or non-finite component are left out, and so are vectors of another length than the
most frequent one that the parts divide (the longer of two equally frequent). Without an id a row is coded like any other,
but is among the first entries only when there are too few ids. Repeated rows are coded each; between rows with one id the
smaller vector is the first. Fewer rows than entries make fewer entries; none make an empty result. Integers beyond 62 bits
count as the nearest 62-bit one, summed errors beyond 63 bits as the largest long. Labels may be null, which is one label.
Other columns are passed on within `doc`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaudit.llm.rows import packed, stored

MOST = 1 << 62
AT_ONCE = 4096  # vectors whose distances are held at once


class Codebooks(NamedTuple):
    """Entries by part, and which of them moved in the last round (all of them at first)."""

    entries: np.ndarray  # part, entry, place within the part
    moved: np.ndarray  # part, entry


class Coded(NamedTuple):
    rows: DataFrame  # doc, code (binary, one byte for each part), error
    entries: np.ndarray


def integers(vector: Column, scale: int) -> Column:
    """Components as integers towards minus infinity."""
    return F.transform(vector, lambda x: F.greatest(F.lit(-MOST), F.least(F.lit(MOST), F.floor(x.cast("double") * scale))))


def _whole(vector: Column) -> Column:
    return vector.isNotNull() & ~F.exists(
        vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))


def distances(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of each part to each entry. Floats are exact while all terms stay below 2**53."""
    most = max(np.abs(parts).max(initial=0), np.abs(entries).max(initial=0))
    floats = 4 * parts.shape[1] * int(most) ** 2 < 1 << 53
    a, b = (x.astype(np.float64 if floats else object) for x in (parts, entries))
    apart = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]
    return apart.astype(np.int64) if floats else apart


def assign(parts: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray | None,
           known: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entries, exact distances to them, and how many distances were computed, for one part position."""
    if code is None:
        apart = distances(parts, entries)
        code = apart.argmin(1)
        return code, apart[np.arange(len(code)), code], apart.size
    code, known = code.astype(np.int64), known.copy()
    active = np.flatnonzero(moved)
    stale = np.flatnonzero(moved[code])
    kept = np.flatnonzero(~moved[code])
    compared = len(stale) * len(entries) + len(kept) * len(active)
    if len(stale):
        code[stale], known[stale], _ = assign(parts[stale], entries, moved, None, None)
    if len(active) and len(kept):
        apart = distances(parts[kept], entries[active])
        nearest = apart.argmin(1)
        apart = apart[np.arange(len(kept)), nearest]
        nearest = active[nearest]
        better = ((apart < known[kept]) | ((apart == known[kept]) & (nearest < code[kept]))).astype(bool)
        code[kept[better]] = nearest[better]
        known[kept[better]] = apart[better]
    return code, known, compared


def _flat(column: pa.Array, kind: str, width: int) -> np.ndarray:
    """Values of a binary column of equal lengths, as a row for each."""
    column = pa.concat_arrays([column]).cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return data.view(kind).reshape(len(column), width)


def _binary(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] * rows.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())])


def _distance_kind(width: int, most: int) -> str:
    """Bytes for a stored distance; entries are means of parts, so `most` bounds both. Text where 63 bits may not do."""
    limit = 4 * width * most ** 2
    return "<u4" if limit < 1 << 32 else "<i8" if limit < 1 << 63 else "S48"


def _known(raw: np.ndarray) -> np.ndarray:
    if raw.dtype.kind != "S":
        return raw.astype(np.int64)
    return np.array([int(x) for x in raw.ravel()], object).reshape(raw.shape)


def assigned(rows: DataFrame, books: Codebooks, vector_kind: str, most: int) -> DataFrame:
    """One round: `code` and `far` (a distance for each part) of every row, from those of the round before if it has any."""
    parts, _, width = books.entries.shape
    again = "code" in rows.columns
    code_kind = "u1" if books.entries.shape[1] <= 256 else "<u2"
    far_kind = _distance_kind(width, most)
    schema = T.StructType([*[f for f in rows.schema if f.name not in ("code", "far")],
                           T.StructField("code", T.BinaryType()), T.StructField("far", T.BinaryType())])
    same = [f.name for f in schema if f.name not in ("code", "far")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, AT_ONCE):
                batch = whole.slice(at, AT_ONCE)
                vectors = _flat(batch.column("vector"), vector_kind, parts * width).reshape(-1, parts, width)
                code = np.zeros((len(vectors), parts), code_kind)
                far = np.zeros((len(vectors), parts), far_kind)
                before = _flat(batch.column("code"), code_kind, parts) if again else None
                known = _known(_flat(batch.column("far"), far_kind, parts)) if again else None
                for p in range(parts):
                    code[:, p], far[:, p], _ = assign(
                        vectors[:, p].astype(np.int64), books.entries[p], books.moved[p],
                        before[:, p] if again else None, known[:, p] if again else None)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(n) for n in same], _binary(code), _binary(far)], [*same, "code", "far"])

    return rows.mapInArrow(run, schema)


def entry_sums(rows: DataFrame, books: Codebooks, vector_kind: str) -> DataFrame:
    """Count, and sum of each component, of the parts of every entry; tasks add up before Spark does."""
    parts, size, width = books.entries.shape
    code_kind = "u1" if size <= 256 else "<u2"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((parts, size), np.int64)
        sums = np.zeros((parts, size, width), object)
        for batch in batches:
            vectors = _flat(batch.column("vector"), vector_kind, parts * width).reshape(-1, parts, width)
            code = _flat(batch.column("code"), code_kind, parts)
            wide = vectors.astype(np.int64 if vectors.itemsize < 8 else object)
            for p in range(parts):
                counts[p] += np.bincount(code[:, p], minlength=size)
                own = np.zeros((size, width), wide.dtype)
                np.add.at(own, code[:, p], wide[:, p])
                sums[p] += own.astype(object)
        part, entry, place = (x.ravel() for x in np.indices(sums.shape))
        used = counts[part, entry] > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(part[used], pa.int32()), pa.array(entry[used], pa.int32()), pa.array(place[used], pa.int32()),
             pa.array(counts[part, entry][used], pa.int64()),
             pa.array([Decimal(int(x)) for x in sums.ravel()[used]], pa.decimal128(38, 0))],
            ["part", "entry", "place", "n", "total"])

    made = rows.select("vector", "code").mapInArrow(run, "part int, entry int, place int, n long, total decimal(38,0)")
    return made.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def moved_entries(books: Codebooks, sums: DataFrame) -> Codebooks:
    """Every used entry at the floored mean of its parts. One row for each component of the codebooks comes here."""
    entries = books.entries.copy()
    for row in sums.collect():
        entries[row.part, row.entry, row.place] = int(row.total) // row.n
    return Codebooks(entries, (entries != books.entries).any(2))


def coded(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", carry: list[str] | None = None,
          parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> Coded:
    """Every whole vector as `doc` with its code, one byte (two beyond 256 entries) for each part, and the sum of its
    final distances; and the final codebooks."""
    rows = packed(vectors, [id, *(carry or []), vector]).where(_whole(F.col("doc").getField(vector)))
    rows = rows.select(F.struct(*[F.col("doc").getField(c).alias(c) for c in dict.fromkeys([id, *(carry or [])])]).alias("doc"),
                       integers(F.col("doc").getField(vector), scale).alias("ints"))
    widest = F.max(F.array_max(F.transform("ints", lambda x: F.abs(x))))
    lengths = rows.groupBy(F.size("ints").alias("size")).agg(F.count("*").alias("n"), widest.alias("most"))
    usual = lengths.where((F.col("size") > 0) & (F.col("size") % parts == 0)).orderBy(
        F.desc("n"), F.desc("size")).first()
    size, most = (usual.size, usual.most) if usual else (parts, 0)
    rows = rows.where(F.size("ints") == size)
    own = F.col("doc").getField(id)
    first = rows.orderBy(own.asc_nulls_last(), "ints").limit(entries).collect()
    width = size // parts
    start = np.array([r.ints for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2)
    books = Codebooks(start, np.ones(start.shape[:2], bool))
    if not first:
        return Coded(rows.select("doc", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error")), start)

    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
    held = _narrowed(rows, kind)
    for _ in range(rounds):
        before, held = held, assigned(held, books, kind, most).persist(StorageLevel.DISK_ONLY)
        books = moved_entries(books, entry_sums(held, books, kind))
        before.unpersist()
    last = stored(_summed(assigned(held, books, kind, most), _distance_kind(width, most), parts), "codes")
    held.unpersist()
    return Coded(last, books.entries)


def _narrowed(rows: DataFrame, kind: str) -> DataFrame:
    """Components in as many bytes as the largest needs."""
    schema = T.StructType([rows.schema["doc"], T.StructField("vector", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("ints")
            vectors = np.asarray(column.flatten(), np.int64).astype(kind).reshape(len(column), -1)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), _binary(vectors)], ["doc", "vector"])

    return rows.mapInArrow(run, schema)


def _summed(rows: DataFrame, far_kind: str, parts: int) -> DataFrame:
    schema = T.StructType([rows.schema["doc"], rows.schema["code"], T.StructField("error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = _known(_flat(batch.column("far"), far_kind, parts)).astype(object)
            error = [min(int(x), (1 << 63) - 1) for x in far.sum(1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("code"), pa.array(error, pa.int64())],
                                             ["doc", "code", "error"])

    return rows.mapInArrow(run, schema)


def with_label_error(rows: DataFrame, label: str) -> DataFrame:
    """Adds `label_error`, the errors of all rows with the same label; nulls are one label. Labels are added up before the
    shuffle, and the sums meet the rows in a join that Spark broadcasts or splits by measured size."""
    own = F.col("doc").getField(label)
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit((1 << 63) - 1).cast("decimal(38,0)"))
    sums = rows.groupBy(own.alias("_label")).agg(total.cast("long").alias("label_error"))
    return rows.join(sums, own.eqNullSafe(F.col("_label"))).drop("_label")


def listed(entries: np.ndarray) -> str:
    """All integers of the codebooks, by part, entry and place."""
    return ",".join(str(int(x)) for x in entries.ravel())
