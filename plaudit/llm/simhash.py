"""Near copies by SimHash, with deletion-variant signatures.

A fingerprint is the bitwise majority of the 64-bit hashes of a text's word shingles. Two fingerprints at three
bits or fewer differ, in one of their two halves, at one bit at most. So every half is indexed as it is and with each of
its bits blanked; fingerprints that share such a key are compared bit by bit.

Equal fingerprints are one node from the start, whatever their number. A key that still holds more than `group`
fingerprints is not compared pairwise: the other half is cut in two, and by the same argument one part differs at one
bit at most, so keys are refined with the variants of these parts, and once more with parts of eight bits. A
group is then at most 2**11 fingerprints by construction. Only a spanning set of links leaves a group; components need no
more.

Null and wordless texts have the fingerprint zero. Rows without an id take part in linking, but an id is never null in
a component that has one. Repeated rows get the same answer each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaudit.llm.components import components
from plaudit.llm.rows import checkpointed, packed, unpacked, with_columns
from plaudit.llm.text import U64, mix

SEED = 42
WIDTHS = (32, 16, 8)  # bits of a part, by level


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Signed 64-bit fingerprint of a whole text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    size = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in
                       zip(starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist(), strict=True)], np.uint64)
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(ones, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3,
                 carry: list[str] | None = None) -> DataFrame:
    return _printed(packed(docs, [id, text, *(carry or [])]), text, shingle)


def _printed(rows: DataFrame, text: str, shingle: int) -> DataFrame:
    def work(batch: pa.RecordBatch, texts: pa.Array) -> dict[str, pa.Array]:
        return {"print": pa.array([fingerprint(t, shingle) for t in texts.to_pylist()], pa.int64())}

    return with_columns(rows, "print long", work, text)


def _variants(prints: np.ndarray, paths: np.ndarray, parts: np.ndarray, level: int):
    """Keys of one level: of each part as it is, and with one bit blanked. paths: the key so far; parts: where the bits
    that are not yet part of it begin. Yields key, blanked bit of the fingerprint (-1 if none), where the rest begins."""
    width = WIDTHS[level]
    for half in (0, 1):
        low = parts + half * width
        value = (prints >> low.astype(U64)) & U64((1 << width) - 1)
        rest = parts + (1 - half) * width
        for bit in range(-1, width):
            kept = value if bit < 0 else value & ~U64(1 << bit)
            tag = ((level * 2 + half) << 8 | (bit + 1)) * 2 + 1
            key = mix(mix(kept + U64(tag * 0x9E3779B97F4A7C15 % (1 << 64))) ^ paths)
            yield key, (low + bit if bit >= 0 else np.full(len(low), -1)), rest


def _keyed(level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                prints, paths = (batch.column(n).to_numpy().view(U64) for n in ("print", "path"))
                parts = batch.column("part").to_numpy().astype(np.int64)
                for key, bit, rest in _variants(prints, paths, parts, level):
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(prints.view(np.int64)),
                                                      pa.array(bit.astype(np.int8)), pa.array(rest.astype(np.int8))],
                                                     ["key", "print", "bit", "part"])

    return run


def _spanning(prints: np.ndarray, bit: int, distance: int) -> list[tuple[int, int]]:
    """Links that connect what pairs at `distance` or less connect; with a blanked bit, of pairs that differ there."""
    left = right = prints
    if bit >= 0:
        side = (prints >> U64(bit)) & U64(1)
        left, right = prints[side == 0], prints[side == 1]
    root = {int(p): int(p) for p in prints}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    for one in left:
        near = right[np.bitwise_count(right ^ one) <= distance]
        for other in near.tolist():
            a, b = find(int(one)), find(other)
            if a != b:
                root[b] = a
                links.append((int(one), other))
    return links


def _linked(level: int, distance: int, group: int):
    """Links of the groups of a key, from rows sorted by it; a larger group is passed on, row by row."""
    last = level == len(WIDTHS) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = bit = None
        held: list[np.ndarray] = []
        rest: list[np.ndarray] = []
        count, passing = 0, False

        def rows(u, v=None, path=None, part=None) -> pa.RecordBatch:
            n = len(u)
            return pa.RecordBatch.from_arrays([
                pa.array(np.asarray(u, U64).view(np.int64)),
                pa.nulls(n, pa.int64()) if v is None else pa.array(np.asarray(v, U64).view(np.int64)),
                pa.nulls(n, pa.int64()) if path is None else pa.array(np.full(n, path, np.int64)),
                pa.nulls(n, pa.int8()) if part is None else pa.array(np.asarray(part, np.int8)),
            ], ["u", "v", "path", "part"])

        def close(prints: np.ndarray, of: int):
            links = _spanning(prints, of, distance) if len(prints) > 1 else []
            return rows(*map(list, zip(*links, strict=True))) if links else None

        for batch in batches:
            keys, bits = batch.column("key").to_numpy(), batch.column("bit").to_numpy()
            prints, parts = batch.column("print").to_numpy().view(U64), batch.column("part").to_numpy()
            change = np.flatnonzero((keys[1:] != keys[:-1]) | (bits[1:] != bits[:-1])) + 1
            bounds = np.r_[0, change, len(keys)]
            sizes = np.diff(bounds)
            edge = np.zeros(len(sizes), bool)
            edge[[0, -1]] = True
            for g in np.flatnonzero((sizes > 1) | edge):  # a lone row within the batch has no partner
                a, b = bounds[g], bounds[g + 1]
                if key != keys[a] or bit != bits[a]:
                    if held and not passing and (out := close(np.concatenate(held), bit)) is not None:
                        yield out
                    key, bit, held, rest, count, passing = keys[a], int(bits[a]), [], [], 0, False
                held.append(prints[a:b])
                rest.append(parts[a:b])
                count += b - a
                if count > group and not last:
                    yield rows(np.concatenate(held), None, key, np.concatenate(rest))
                    held, rest, passing = [], [], True
        if held and not passing and (out := close(np.concatenate(held), bit)) is not None:
            yield out

    return run


def links(prints: DataFrame, distance: int = 3, group: int = 512) -> DataFrame:
    """(u, v) links that connect distinct fingerprints as all pairs at `distance` (3 at most) or less would."""
    if not 0 <= distance <= 3:
        raise ValueError("two halves find distances up to 3")
    # A row becomes 66; a number of partitions that is given is not merged for the small size of the rows before.
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = prints.repartition(parts, "print").select(
        "print", F.lit(0).cast("long").alias("path"), F.lit(0).cast("byte").alias("part"))
    found = None
    for level in range(len(WIDTHS)):
        keyed = rows.mapInArrow(_keyed(level), "key long, print long, bit byte, part byte")
        parted = keyed.repartition("key").sortWithinPartitions("key", "bit")
        out = checkpointed(parted.mapInArrow(_linked(level, distance, group), "u long, v long, path long, part byte"))
        here = out.filter("path is null").select("u", "v")
        found = here if found is None else found.union(here)
        rows = out.filter("path is not null").select(F.col("u").alias("print"), "path", "part")
        if level == len(WIDTHS) - 1 or rows.isEmpty():
            return found


def classes(prints: DataFrame, distance: int = 3, group: int = 512) -> DataFrame:
    """(print, root, component_id) from rows (print, id): the component's smallest fingerprint, and the smallest id
    reachable over links, itself included."""
    nodes = checkpointed(prints.groupBy("print").agg(F.min("id").alias("least")))
    roots = components(links(nodes.select("print"), distance, group))
    placed = (nodes.join(roots, nodes["print"] == roots["node"], "left")
              .select("print", "least", F.coalesce("root", "print").alias("root")))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return placed.join(least, "root").select("print", "root", "component_id")


def near_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3,
                group: int = 512) -> DataFrame:
    """Every row's id with its fingerprint (signed) and component_id."""
    prints = checkpointed(fingerprints(docs, id, text, shingle).select(F.col("doc").getField(id).alias("id"), "print"))
    found = classes(prints, distance, group)
    return prints.join(found, "print").select(F.col("id").alias(id), F.col("print").alias("fingerprint"),
                                              "component_id")


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3,
                group: int = 512) -> DataFrame:
    """The rows of `docs` with one document of each component: the one with the smallest id, of several rows with that id
    the first by text. A row without id stays only if its component has no id; of several the first by text. Rows of one id
    may lie in several components, and one of each stays."""
    prints = checkpointed(fingerprints(docs, id, text, shingle).select(F.col("doc").getField(id).alias("id"), "print"))
    found = checkpointed(classes(prints, distance, group))
    chosen = found.select(F.col("component_id").alias("id")).dropna().distinct()
    several = prints.groupBy("id").agg((F.count("*") > 1).alias("several"))
    chosen = checkpointed(chosen.join(several, "id"))
    rows = packed(docs, docs.columns)
    own = F.col("doc").getField(id)
    alone = rows.join(chosen.filter("not several"), own == F.col("id"), "left_semi")
    # An id of several rows, or none, does not tell the component: these rows get their fingerprint again.
    shared = rows.join(chosen.filter("several"), own == F.col("id"), "left_semi").union(rows.filter(own.isNull()))
    first = _printed(shared, text, shingle).join(found, "print").filter(own.eqNullSafe(F.col("component_id"))).groupBy(
        "root").agg(F.min_by("doc", F.struct(F.col("doc").getField(text))).alias("doc"))
    return unpacked(alone.union(first.select("doc")))
