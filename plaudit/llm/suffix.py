"""Repeated byte strings, by suffix arrays over groups of text that can hold the same strings.

Every window of `length` bytes belongs to the class of its anchor, the smallest hash among its inner byte groups: equal
windows have equal anchors. Consecutive windows of one class form a slice of text. A count-min sketch sorts out the
classes that occur once. Equal slices (by 128 bits of hash) are counted before anything is shuffled by key: all their
windows repeat. Of a class with several different slices one copy of each is sent to a task, where a suffix array to the depth
of `length` is built over about a megabyte of such slices by prefix doubling. The nearest smaller positions before and after
a suffix in that order give its longest previous factor, the nearest larger ones its longest next factor; a place
whose factor has `length` bytes begins a string that occurs elsewhere.

A class with more than `most` bytes of different slices is not gathered in a task: its slices are dealt anew by anchors of
another hash, with smaller groups of bytes, and if need be once more; in the last round the anchor is the
whole window, so that a class holds one string. No string is left out on the way.

keep="none" removes every copy of a repeated string; keep="first" removes the later ones, in the order of id and
place. Null counts as empty. Rows are told apart by their texts: repeated rows and exact copies are copies of each other,
with or without an id; with keep="first" the copy with the smallest id is the first, a row without id is never before another.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaudit.llm.rows import checkpointed, packed, text_of, text_slices, with_columns
from plaudit.llm.sketch import sketched
from plaudit.llm.text import U64, bytes_of, group_hashes, mix, prefix_sums, runs, sliding_min, span_hashes

GROUPS = (64, 48, 32)  # bytes of an inner group, by round; the last round takes the whole window
AT_ONCE = 1 << 20


def slices_of(data: np.ndarray, offsets: np.ndarray, length: int, round: int):
    """Class, begin and end of the slices of all rows, and whether the anchor may stand more than once in a slice, so that
    a window may repeat within it."""
    group = GROUPS[round] if round < len(GROUPS) and GROUPS[round] < length else length
    count = len(data) - length + 1
    if count <= 0:
        return np.empty(0, U64), *[np.empty(0, np.int64)] * 2, np.empty(0, bool)
    lane = 2 + round
    hashes = group_hashes(data, group, lane)
    # Of equal smallest hashes the first counts; hashes are compared without their last bits, which hold the place.
    low = U64(int(len(hashes)).bit_length())
    places = sliding_min(hashes >> low << low | np.arange(len(hashes), dtype=U64), length - group + 1)
    places = (places & ((U64(1) << low) - U64(1))).astype(np.int64)
    anchors = hashes[places]
    inside = np.repeat(offsets[1:], np.diff(offsets))[:count] >= np.arange(length, count + length)
    new = np.r_[True, (anchors[1:] != anchors[:-1]) | ~inside[:-1]] & inside
    last = np.r_[(anchors[1:] != anchors[:-1]) | ~inside[1:], True] & inside
    starts, lasts = np.flatnonzero(new), np.flatnonzero(last)
    return anchors[starts], starts, lasts + length, places[starts] != places[lasts]


def _dealt(rows: DataFrame, length: int, sketch) -> DataFrame:
    """Slices of the documents whose class the sketch takes for repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            data, offsets = bytes_of(text_of(batch, "text"))
            classes, starts, ends, own = slices_of(data, offsets, length, 0)
            chosen = sketch.value.repeated(classes)
            if not chosen.any():
                continue
            classes, starts, ends, own = classes[chosen], starts[chosen], ends[chosen], own[chosen]
            row = np.searchsorted(offsets, starts, "right") - 1
            owner = pa.array(row)
            first, second = (span_hashes(prefix_sums(data, k), starts, ends, k).view(np.int64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([
                pa.array(classes.view(np.int64)), pa.array(first), pa.array(second),
                *[pa.compute.struct_field(batch.column("doc"), c).take(owner) for c in ("k1", "k2", "id")],
                pa.array((starts - offsets[row]).astype(np.int32)), pa.array((ends - offsets[row]).astype(np.int32)),
                pa.array(own),
            ], ["class", "h1", "h2", "k1", "k2", "id", "start", "stop", "own"])

    return rows.mapInArrow(run, "class long, h1 long, h2 long, k1 long, k2 long, id long, start int, stop int, "
                                "own boolean")


def _cut(rows: DataFrame) -> DataFrame:
    """Bytes of chosen slices. rows: doc and slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            data, offsets = bytes_of(text_of(batch, "text"))
            lists = batch.column("slices")
            flat = lists.flatten()
            owner = np.repeat(np.arange(batch.num_rows), np.asarray(pa.compute.list_value_length(lists)))
            starts, stops = (np.asarray(flat.field(k)) + offsets[owner] for k in ("start", "stop"))
            keys = pa.array(owner)
            yield pa.RecordBatch.from_arrays([
                *[flat.field(k) for k in ("class", "h1", "h2")],
                *[pa.compute.struct_field(batch.column("doc"), c).take(keys) for c in ("k1", "k2")],
                *[flat.field(k) for k in ("id", "start", "copies", "own")],
                pa.array([data[a:b].tobytes() for a, b in zip(starts, stops, strict=True)], pa.binary()),
            ], SLICE_COLUMNS)

    return rows.mapInArrow(run, SLICES)


SLICE_COLUMNS = ["class", "h1", "h2", "k1", "k2", "id", "start", "copies", "own", "slice"]
SLICES = ("class long, h1 long, h2 long, k1 long, k2 long, id long, start int, copies long, own boolean, slice binary")


def _redealt(rows: DataFrame, length: int, round: int) -> DataFrame:
    """Slices of slices, by the anchors of another round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                data, offsets = bytes_of(batch.column("slice").cast(pa.large_binary()))
                classes, starts, ends, own = slices_of(data, offsets, length, round)
                row = np.searchsorted(offsets, starts, "right") - 1
                owner = pa.array(row)
                before = batch.column("class").take(owner).to_numpy().view(U64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(mix(classes ^ mix(before)).view(np.int64)),
                    *[pa.array(span_hashes(prefix_sums(data, k), starts, ends, k).view(np.int64)) for k in (0, 1)],
                    *[batch.column(c).take(owner) for c in ("k1", "k2", "id")],
                    pa.array((np.asarray(batch.column("start"))[row] + starts - offsets[row]).astype(np.int32)),
                    batch.column("copies").take(owner), pa.array(own),
                    pa.array([data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
                ], SLICE_COLUMNS)

    return rows.mapInArrow(run, SLICES)


class Suffixes(NamedTuple):
    """Suffixes that have `depth` bytes of their row, in the order of these bytes and then of place."""

    order: np.ndarray
    ranks: list[tuple[int, np.ndarray]]  # by length: numbers of the strings of that length at each place, in their order
    words: np.ndarray  # the eight bytes at each place, beyond the row too
    depth: int


def suffix_array(data: np.ndarray, offsets: np.ndarray, depth: int) -> Suffixes:
    """By prefix doubling up to `depth`, over all rows at once."""
    size = len(data)
    ends = np.repeat(offsets[1:], np.diff(offsets))
    padded = np.zeros(size + 8, np.uint64)
    padded[:size] = data
    words = np.zeros(size, np.uint64)
    for k in range(8):  # bytes beyond the row do not matter: only strings within it are taken at the end
        words = words << U64(8) | padded[k:k + size]
    reach = min(8, depth)
    _, rank = np.unique(words >> U64(8 * (8 - reach)), return_inverse=True)
    ranks = [(reach, rank)]
    while reach < depth:
        step = min(reach, depth - reach)
        after = np.zeros(size, np.int64)
        after[:max(0, size - step)] = rank[step:] + 1
        _, rank = np.unique(rank * np.int64(size + 1) + after, return_inverse=True)
        reach += step
        ranks.append((reach, rank))
    places = np.flatnonzero(np.arange(size) + depth <= ends)
    return Suffixes(places[np.argsort(rank[places], kind="stable")], ranks, words, depth)


def smaller_before(values: np.ndarray) -> np.ndarray:
    """For each entry the nearest one before it that is smaller, or -1.

    All entries jump at once: one that is not smaller points to an entry before it, with none but larger ones between, so
    what it points to may be taken over, also while that is still on its way. Each step doubles the reach.
    """
    found = np.arange(-1, len(values) - 1)
    active = np.arange(len(values))
    while len(active):
        at = found[active]
        active = active[(at >= 0) & (values[at] >= values[active])]
        found[active] = found[found[active]]
    return found


def common_prefix(suffixes: Suffixes, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bytes that the strings at two places have in common, `depth` at most, by the numbers of ever shorter strings."""
    common = np.zeros(len(a), np.int64)
    size = len(suffixes.words)
    for length, rank in reversed(suffixes.ranks):
        more = common + length <= suffixes.depth
        x, y = (np.minimum(p + common, size - 1) for p in (a, b))
        common += np.where(more & (rank[x] == rank[y]), length, 0)
    x, y = (suffixes.words[np.minimum(p + common, size - 1)] for p in (a, b))
    apart = x ^ y
    for k in range(7, 0, -1):  # whole bytes alike, of the eight that are next
        alike = apart >> U64(8 * (8 - k)) == 0
        common = np.where(alike, common + k, common)
        apart = np.where(alike, U64(1) << U64(63), apart)
    return np.minimum(common, suffixes.depth)


def factors(data: np.ndarray, offsets: np.ndarray, depth: int, following: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Longest previous and longest next factor at each place, up to `depth`: how many bytes from there on also stand at an
    earlier place, and at a later one. Places with less than `depth` bytes of their row have 0, as have all next factors
    unless they are asked for.

    Of all earlier suffixes the two that are nearest in suffix order share most with a suffix: the nearest smaller position
    before it, and after it. For later ones these are the nearest larger positions.
    """
    suffixes = suffix_array(data, offsets, depth)
    order = suffixes.order

    def longest(values: np.ndarray) -> np.ndarray:
        found = np.zeros(len(data), np.int64)
        for way in (slice(None), slice(None, None, -1)):
            own = order[way]
            near = smaller_before(values[way])
            has = np.flatnonzero(near >= 0)
            found[own[has]] = np.maximum(found[own[has]], common_prefix(suffixes, own[has], own[near[has]]))
        return found

    return longest(order), longest(-order) if following else np.zeros(len(data), np.int64)


RESULT = SLICES + ", stop int"
RESULT_COLUMNS = [*SLICE_COLUMNS, "stop"]


def _searched(length: int, most: int, first: bool):
    """Spans of the slices, from rows sorted by class; rows of a class that is too large are passed on."""

    def spans(rows: pa.Table) -> pa.RecordBatch | None:
        data, offsets = bytes_of(rows["slice"].combine_chunks().cast(pa.large_binary()))
        previous, following = factors(data, offsets, length, not first)
        found = np.maximum(previous, following) >= length
        steps = np.zeros(len(data) + 1, np.int32)
        at = np.flatnonzero(found)
        steps[at] += 1
        np.subtract.at(steps, at + length, 1)
        # A span ends with its slice, even if the next begins covered.
        inside = np.cumsum(steps[:-1]) > 0
        starts, stops = runs(inside)
        row = np.searchsorted(offsets, starts, "right") - 1
        last = np.searchsorted(offsets, stops, "left") - 1
        if (row != last).any():
            marks = np.unique(np.concatenate([starts, offsets[(offsets > 0) & (offsets < len(data))]]))
            marks = marks[inside[marks]]
            stops = np.minimum(stops[np.searchsorted(starts, marks, "right") - 1],
                               offsets[np.searchsorted(offsets, marks, "right")])
            starts, row = marks, np.searchsorted(offsets, marks, "right") - 1
        if not len(starts):
            return None
        owner, begin = pa.array(row), np.asarray(rows["start"])[row] - offsets[row]
        n = len(row)
        nothing = pa.nulls(n, pa.int64())
        return pa.RecordBatch.from_arrays([
            nothing, nothing, nothing, *[rows[c].combine_chunks().take(owner) for c in ("k1", "k2", "id")],
            pa.array((begin + starts).astype(np.int32)), nothing, pa.nulls(n, pa.bool_()), pa.nulls(n, pa.binary()),
            pa.array((begin + stops).astype(np.int32))], RESULT_COLUMNS)

    def passed(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        for batch in rows.append_column("stop", pa.nulls(rows.num_rows, pa.int32())).to_batches():
            yield batch

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        large = None

        def settle(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            """Whole classes, about a megabyte at once."""
            keys = rows["class"].to_numpy()
            bounds = np.r_[0, np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)]
            sizes = np.r_[0, np.cumsum(np.asarray(pa.compute.binary_length(rows["slice"]), np.int64))][bounds]
            at = 0
            while at < len(bounds) - 1:
                to = max(at + 1, int(np.searchsorted(sizes, sizes[at] + AT_ONCE, "right")) - 1)
                part = rows.slice(bounds[at], bounds[to] - bounds[at])
                if to == at + 1 and sizes[to] - sizes[at] > most:
                    yield from passed(part)
                elif (out := spans(part)) is not None:
                    yield out
                at = to

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            keys = rows["class"].to_numpy()
            cut = len(keys) - int(np.argmax(keys[::-1] != keys[-1])) if keys[0] != keys[-1] else 0
            if large is not None and keys[0] == large:
                n = int(np.argmax(keys != large)) if keys[0] != keys[-1] else len(keys)
                yield from passed(rows.slice(0, n))
                rows, cut = rows.slice(n), max(0, cut - n)
                held = None
                if not rows.num_rows:
                    continue
                keys = keys[n:]
            large = None
            if cut:
                yield from settle(rows.slice(0, cut))
            held = rows.slice(cut)
            if pa.compute.sum(pa.compute.binary_length(held["slice"])).as_py() > most:
                large, rest = keys[-1], held
                held = None
                yield from passed(rest)
        if held is not None and held.num_rows:
            yield from settle(held)

    return run


def _several(slices: DataFrame, own) -> DataFrame:
    """Slices of the classes in which something may repeat besides whole slices. The classes are stored first, so that
    a large one can be split in the join."""
    kinds = slices.groupBy("class").agg(F.count("*").alias("kinds"), F.max(own).alias("own"))
    chosen = checkpointed(kinds.filter("kinds > 1 or own").select("class"))
    return slices.join(chosen, "class", "left_semi")


def _whole(members: DataFrame, copied: DataFrame, first: bool) -> DataFrame:
    """Members whose slices have copies; with `first` without the first copy. A text's key stands for all its rows, the
    later of which are removed at the end."""
    found = members.join(copied, ["class", "h1", "h2"])
    if first:
        found = found.filter((F.col("k1") != F.col("rep.k1")) | (F.col("k2") != F.col("rep.k2"))
                             | (F.col("start") != F.col("rep.start")))
    return found.select("k1", "k2", "start", "stop")


def _by_slice(rows: DataFrame) -> DataFrame:
    """One row for each class and slice, the copies summed; the first copy by id and place is kept."""
    best = F.min_by(F.struct("k1", "k2", "id", "start", "own", "slice"), F.struct(F.col("id").isNull(), "id", "start"))
    return (rows.groupBy("class", "h1", "h2").agg(F.sum("copies").alias("copies"), best.alias("r"))
            .select("class", "h1", "h2", "r.k1", "r.k2", "r.id", "r.start", "copies", "r.own", "r.slice"))


def repeated_spans(rows: DataFrame, length: int, first: bool, most: int, max_bits: int, size: int) -> DataFrame:
    """(k1, k2, spans) for the texts with repeated strings. rows: doc with k1, k2 (a text's hashes), id and text."""
    spark = rows.sparkSession

    def keys(batch: pa.RecordBatch) -> np.ndarray:
        classes, _, _, own = slices_of(*bytes_of(text_of(batch, "text")), length, 0)
        return np.concatenate([classes, classes[own]])

    # A slice comes with about 170 bytes of text at a length of 400.
    sketch = spark.sparkContext.broadcast(sketched(rows, "text", keys, 2.4 * size / length, max_bits))
    place = ["class", "h1", "h2", "k1", "k2", "start", "stop"]
    members = checkpointed(_dealt(rows, length, sketch).groupBy(*place).agg(
        F.count("*").alias("n"), F.min("id").alias("id"), F.first("own").alias("own")))
    found = checkpointed(members.groupBy("class", "h1", "h2").agg(F.sum("n").alias("copies"), F.min_by(
        F.struct("k1", "k2", "id", "start", "stop", "own"), F.struct(F.col("id").isNull(), "id", "start")).alias("r")))
    needed = (_several(found, F.col("r.own"))
              .groupBy(F.col("r.k1").alias("s1"), F.col("r.k2").alias("s2"))
              .agg(F.collect_list(F.struct("class", "h1", "h2", "r.id", "r.start", "r.stop", "copies",
                                             "r.own")).alias("slices")))
    texts = rows.join(needed, (F.col("doc.k1") == F.col("s1")) & (F.col("doc.k2") == F.col("s2"))).select("doc", "slices")
    # A text may stand in many rows: each of its slices is taken once, before the shuffle.
    cut = _cut(texts).groupBy("class", "h1", "h2").agg(F.first(F.struct(
        "k1", "k2", "id", "start", "copies", "own", "slice")).alias("r")).select("class", "h1", "h2", "r.*")
    copies = found.filter("copies > 1").select("class", "h1", "h2", F.col("r").alias("rep"))
    spans = _whole(members, copies, first)
    slices = cut
    for round in range(1, len(GROUPS) + 2):
        chosen = slices if round == 1 else _several(slices, F.col("own"))
        parted = chosen.repartition("class").sortWithinPartitions("class", F.col("id").asc_nulls_last(), "start")
        last = round > len(GROUPS)
        out = checkpointed(parted.mapInArrow(_searched(length, most if not last else 1 << 62, first), RESULT))
        spans = spans.union(out.filter("class is null").select("k1", "k2", "start", "stop"))
        large = out.filter("class is not null").drop("stop")
        if last or large.isEmpty():
            break
        again = _redealt(large, length, round).select("*", (F.col("start") + F.octet_length("slice")).alias("stop"))
        slices = checkpointed(_by_slice(again))
        copied = slices.filter("copies > 1").select("class", "h1", "h2", F.struct("k1", "k2", "start").alias("rep"))
        spans = spans.union(_whole(again, copied, first))
    return spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


def without_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = 400, keep: str = "none",
                    carry: list[str] | None = None, most: int = 4 << 20, max_bits: int = 27) -> DataFrame:
    """Every row of `docs` as `doc` with n_bytes, n_removed, the removed spans (in bytes of the text) and the kept
    bytes."""
    if keep not in ("none", "first"):
        raise ValueError("keep is 'none' or 'first'")
    first = keep == "first"
    whole = F.coalesce(F.col("doc").getField(text), F.lit(""))
    hashed = packed(docs, [id, text, *(carry or [])]).select(
        "doc", F.xxhash64(whole).alias("k1"), F.xxhash64(F.lit(1), whole).alias("k2"))
    rows = hashed.select(F.struct("k1", "k2", F.col("doc").getField(id).cast("long").alias("id"),
                                  whole.alias("text")).alias("doc"))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    found = repeated_spans(rows, length, first, most, max_bits, size)
    if first:
        least = rows.select("doc.k1", "doc.k2", "doc.id").groupBy("k1", "k2").agg(
            F.min("id").alias("least"), F.count("*").alias("texts")).filter("texts > 1")
        found = found.join(least, ["k1", "k2"], "full")
    else:
        found = found.select("*", F.lit(None).cast("long").alias("least"), F.lit(None).cast("long").alias("texts"))
    joined = hashed.join(found, ["k1", "k2"], "left").select("doc", "spans", "least", "texts")

    def work(batch: pa.RecordBatch, texts: pa.Array) -> dict[str, pa.Array]:
        data, offsets = bytes_of(texts)
        ids = pa.compute.struct_field(batch.column("doc"), id).to_pylist()
        given, least, times = (batch.column(c).to_pylist() for c in ("spans", "least", "texts"))
        n_bytes = np.diff(offsets)
        n_removed, spans, rest = [], [], []
        for i, n in enumerate(n_bytes.tolist()):
            own = data[offsets[i]:offsets[i + 1]]
            steps = np.zeros(n + 1, np.int32)
            for s in given[i] or ():
                steps[s["start"]] += 1
                steps[s["stop"]] -= 1
            gone = np.cumsum(steps[:-1]) > 0
            if times[i] and n >= length and ids[i] != least[i]:
                gone[:] = True
            n_removed.append(int(gone.sum()))
            spans.append([{"start": int(a), "stop": int(b)} for a, b in zip(*runs(gone), strict=True)])
            rest.append(own[~gone].tobytes() if n_removed[-1] else own.tobytes())
        return {"n_bytes": pa.array(n_bytes), "n_removed": pa.array(n_removed, pa.int64()),
                "removed": pa.array(spans, SPANS), "kept": pa.array(rest, pa.binary())}

    return with_columns(joined, "n_bytes long, n_removed long, removed array<struct<start: int, stop: int>>, kept binary",
                        work, text).drop("spans", "least", "texts")
