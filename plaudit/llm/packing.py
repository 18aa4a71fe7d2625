"""Token sequences of a fixed length, packed first-fit decreasing.

Documents are tokenized and cut: whole lengths are sequences of their own, what is left over is packed. The leftovers are
dealt at random (a hash of id and text) into groups of at most `group` pieces, and each group is packed by itself:
longest piece first, into the first sequence with room for it, which a tournament tree over the sequences' room finds in
logarithmic time. At last the emptiest sequences of a group are taken apart and their pieces are cut into the room that
is left in the others, as long as a cut has `least_cut` tokens at least.

A group is a run of rows of one partition, in the order of the hash, so that no group grows with the input and a lost
task makes the same sequences again. Null counts as an empty document. Repeated rows are packed each; a document without
tokens but the closing one is a piece of one token.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaudit.llm.rows import packed, text_of, text_slices

LENGTH = 2048
CLOSING = 1  # the id after each document
KNOWN = 500_000  # words whose ids a worker remembers


def _byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte: itself if it prints, else the next from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + k) for k, b in enumerate(others)}


BYTES = _byte_letters()


class _Known(dict):
    """Ids of words, found when a word is first asked for; all are forgotten when they are too many."""

    def __init__(self, found: Callable[[str], bytes]) -> None:
        self.found = found

    def __missing__(self, word: str) -> bytes:
        if len(self) >= KNOWN:
            self.clear()
        ids = self[word] = self.found(word)
        return ids


class WordIds:
    """Ids of whole texts. Words are looked up one by one where that is the same as asking the library for the text:
    in Latin script, where its normalisation and its word pattern are plain, and without its special strings."""

    #: The tokenizer's word pattern, over lower-case Latin text.
    LETTERS = "".join(c for c in map(chr, range(0x250)) if unicodedata.category(c)[0] == "L" and c == c.lower())
    DIGITS = "".join(c for c in map(chr, range(0x250)) if unicodedata.category(c)[0] == "N")
    PATTERN = re.compile(f"[{LETTERS}]+|[{DIGITS}]|'s|'t|'re|'ve|'m|'ll|'d|[^ \t\n\r{LETTERS}{DIGITS}]+")
    FOREIGN = re.compile("[^\t\n\r\x20-\x7e\xa1-įı-ſ]|<\\|")
    ASCII_PATTERN = re.compile("[a-z]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^ \t\n\ra-z0-9]+")
    PLAIN = bytes([9, 10, 13, *range(0x20, 0x7F)])  # ASCII that is not foreign

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known = _Known(self._word)

    def _word(self, word: str) -> bytes:
        """Ids of one word, which is what is left to do once the text has been normalised and split."""
        if not (word.isascii() and word.isalnum()):  # these bytes print, so they are their own letters
            word = word.encode().decode("latin-1").translate(BYTES)
        found = self.model.tokenize(word)
        return struct.pack(f"<{len(found)}I", *[t.id for t in found])

    def __call__(self, text: str) -> bytes:
        ascii = text.isascii()
        if "<|" in text or text.encode().translate(None, self.PLAIN) if ascii else self.FOREIGN.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        pattern = self.ASCII_PATTERN if ascii else self.PATTERN
        return b"".join(map(self.known.__getitem__, pattern.findall(text.lower())))


@lru_cache(2)
def word_ids(path: str) -> WordIds:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks side by side
    return WordIds(path)


class Tournament:
    """Room of sequences in a tree whose nodes hold the largest room below them."""

    def __init__(self, places: int, room: int) -> None:
        self.size = 1 << max(0, places - 1).bit_length()
        self.room = [room] * (2 * self.size)
        self.used = 0

    def first_with(self, need: int) -> int:
        """The first place with so much room."""
        node = 1
        while node < self.size:
            node *= 2
            node += self.room[node] < need
        return node - self.size

    def take(self, place: int, amount: int) -> None:
        node = place + self.size
        room = self.room
        room[node] -= amount
        self.used = max(self.used, place + 1)
        while node > 1:
            node //= 2
            larger = max(room[2 * node], room[2 * node + 1])
            if room[node] == larger:
                break
            room[node] = larger

    def left(self, place: int) -> int:
        return self.room[place + self.size]


def first_fit_decreasing(lengths: list[int], length: int, least_cut: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (piece, begin, size); pieces may be cut to fill sequences up."""
    tree = Tournament(len(lengths), length)
    bins: list[list[tuple[int, int, int]]] = []
    for piece in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        place = tree.first_with(lengths[piece])
        if place == len(bins):
            bins.append([])
        bins[place].append((piece, 0, lengths[piece]))
        tree.take(place, lengths[piece])
    room = [tree.left(k) for k in range(len(bins))]
    # The sequences with the most room are taken apart for the others, those with the least room being filled last.
    order = sorted(range(len(bins)), key=lambda k: (room[k], k))
    open_room = [k for k in order if room[k] >= least_cut]
    free = sum(room[k] for k in open_room)
    while len(open_room) > 1:
        giver = open_room[-1]
        content = length - room[giver]
        # Each place may lose up to least_cut to remnants that are too short to cut off.
        if free - room[giver] - least_cut * (len(open_room) - 1) < content:
            break
        open_room.pop()
        free -= room[giver]
        for piece, begin, size in bins[giver]:
            while size:
                place = open_room[-1]
                part = min(size, room[place])
                if 0 < size - part < least_cut and part > least_cut:
                    part = max(least_cut, part - least_cut)
                bins[place].append((piece, begin, part))
                begin, size, room[place], free = begin + part, size - part, room[place] - part, free - part
                if room[place] < least_cut:
                    free -= room[place]
                    open_room.pop()
        bins[giver] = []
    return [b for b in bins if b]


def _tokenized(id: str, text: str, path: str, length: int):
    """Whole lengths as sequences with their checksum; leftovers with their ids."""
    schema = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("doc_tokens", pa.int64()),
                        ("crc", pa.int64()), ("ids", pa.binary()), ("deal", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = word_ids(path)
        closing = np.array([CLOSING], "<u4").tobytes()
        for batch in text_slices(batches, text):
            rows = []
            for doc, whole, deal in zip(pa.compute.struct_field(batch.column("doc"), id).to_pylist(),
                                        text_of(batch, text).to_pylist(), batch.column("deal").to_pylist(),
                                        strict=True):
                data = ids_of(whole or "") + closing
                total = len(data) // 4
                for start in range(0, total, length):
                    part = data[4 * start:4 * (start + length)]
                    full = len(part) == 4 * length
                    # Ids below 2**16 travel in two bytes; this tokenizer has no others, one with more would raise.
                    rows.append((doc, start, len(part) // 4, total, zlib.crc32(part) if full else None,
                                 None if full else _narrow(part), deal))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in
                                              zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run, schema


def _narrow(ids: bytes) -> bytes:
    wide = np.frombuffer(ids, "<u4")
    if len(wide) and wide.max() >= 1 << 16:
        raise ValueError("token ids above 65535 are not supported")
    return wide.astype("<u2").tobytes()


def _packed(length: int, group: int, least_cut: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 40
        used = 0

        def rows_of() -> Iterator[tuple]:
            for batch in batches:
                columns = [batch.column(n).to_pylist() for n in
                           ("id", "start", "length", "doc_tokens", "crc", "ids")]
                yield from zip(*columns, strict=True)

        source = rows_of()
        while chunk := list(islice(source, group)):
            out = []
            rest = []
            for row in chunk:
                if row[5] is None:
                    out.append((row[0], row[1], row[2], row[4], row[3], base + used, 0))
                    used += 1
                else:
                    rest.append(row)
            for sequence in first_fit_decreasing([r[2] for r in rest], length, least_cut):
                offset = 0
                for piece, begin, size in sequence:
                    doc, start, _, total, _, ids = rest[piece]
                    part = np.frombuffer(ids, "<u2")[begin:begin + size].astype("<u4").tobytes()
                    out.append((doc, start + begin, size, zlib.crc32(part), total, base + used, offset))
                    offset += size
                used += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*out, strict=True)],
                ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return run


def sequences(docs: DataFrame, tokenizer_path: str, id: str = "doc_id", text: str = "text", length: int = LENGTH,
              group: int = 8192, least_cut: int = 16, seed: int = 20) -> DataFrame:
    """A row for each piece: the document's id, where the piece starts among its tokens, length, checksum of its ids,
    the document's tokens, the sequence and the place in it."""
    if length < 2 or least_cut < 1:
        raise ValueError("length must be 2 and least_cut 1 at least")
    rows = packed(docs, [id, text]).withColumn(
        "deal", F.xxhash64(F.lit(seed), F.col("doc").getField(id), F.col("doc").getField(text)))
    work, schema = _tokenized(id, text, tokenizer_path, length)
    made = rows.mapInArrow(work, "id long, start long, length int, doc_tokens long, crc long, ids binary, deal long")
    dealt = made.repartition("deal").sortWithinPartitions("deal", "id", "start")
    return dealt.mapInArrow(_packed(length, group, least_cut),
                            "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
                            "offset long").withColumnRenamed("id", id)
