"""Token ids in binary files of fixed width: every id takes the bits that the vocabulary's largest id needs.

A file holds whole documents, one after another in ascending order of their ids. All numbers are little-endian:

    header    8 bytes MAGIC, u32 bits, u32 ids in a block, u32 bucket, u32 0, u64 number of the first id among those of the
              bucket, u64 ids, u64 documents, u64 crc32 of everything behind the header
    ids       i64 for each document (0 if it has none), then u64 1 for each that has one, 0 else
    starts    u64 for each document and one more: where its ids begin, counted from the file's first
    offsets   u64 for each block and one more: the byte of the file at which it begins
    blocks    ids, each in `bits` bits, the lowest bit first; eight ids fill `bits` whole bytes

and a line feed, which is what Spark's writer puts behind a record. `TokenFile` reads any stretch of ids by unpacking the
blocks it lies in with numpy; it works on bytes or on a memory-mapped file. Beside the files stands a small table of the
buckets, with the number of each bucket's first id among all, by which `ids_between` opens only files that hold the ids asked for.

Writing: a bounded sample of the ids cuts the documents into buckets, ranges of ids. They are tokenized once and shuffled
to their buckets; each bucket is sorted and written by one task, in files of about `file_ids` ids, so that no task holds more
than one file and one document. The files' headers then tell the buckets' lengths. Spark's committer makes a lost task's
files anew.

Null text counts as an empty document, which is its closing id alone. Documents without an id come last. Documents with one
id stand in the order of a hash of their texts, and share out over buckets if they are many; so do many equal rows, in turn. A
long text is a document like any other and never cut. An empty table makes no files. Columns of the input that are not
named are not looked at, whatever their names.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaudit.llm.packing import CLOSING, word_ids
from plaudit.llm.rows import durable, packed, text_of, text_slices

MAGIC = b"TOKBITS1"
HEADER = struct.Struct("<8sIIIIQQQQ")
BLOCK_IDS = 4096
FILE_IDS = 1 << 23
BUCKET_BYTES = 1 << 29  # of text
LEAST_BUCKET_BYTES = 1 << 18
SAMPLE = 1_000_000  # ids that may come to the driver to cut the buckets
SAMPLES = 20  # of them for each bucket
AT_ONCE = 1 << 18  # ids that are packed or unpacked at once


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def _lanes(bits: int) -> Iterator[tuple[int, int, int, int]]:
    """For each of eight ids: its number, its first byte among their `bits` bytes, the shift there, and its bytes."""
    for lane in range(8):
        byte, shift = divmod(lane * bits, 8)
        yield lane, byte, shift, (shift + bits + 7) // 8


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in `bits` bits each, filled up with zeros to a multiple of eight ids."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id does not fit in {bits} bits")
    eights = np.zeros((-(-len(ids) // 8), 8), np.uint64)
    eights.ravel()[:len(ids)] = ids
    if bits in (8, 16, 32):
        return eights.astype(f"<u{bits // 8}").tobytes()
    out = np.zeros((len(eights), bits), np.uint8)
    for lane, byte, shift, size in _lanes(bits):
        value = eights[:, lane] << np.uint64(shift)
        for k in range(size):
            out[:, byte + k] |= (value >> np.uint64(8 * k)).astype(np.uint8)
    return out.tobytes()


def unpack(data, bits: int, count: int) -> np.ndarray:
    """The first `count` ids of packed bytes."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype("<u4")
    eights = np.frombuffer(data, np.uint8, -(-count // 8) * bits).reshape(-1, bits)
    out = np.empty((len(eights), 8), "<u4")
    for lane, byte, shift, size in _lanes(bits):
        value = np.zeros(len(eights), np.uint64)
        for k in range(size):
            value |= eights[:, byte + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, lane] = (value >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
    return out.ravel()[:count]


def file_of(docs: np.ndarray, known: np.ndarray, counts: np.ndarray, ids: list[np.ndarray], bucket: int, first: int,
            bits: int, block: int = BLOCK_IDS) -> bytes:
    """One file, whose first id is number `first` of the bucket. `ids` are arrays that hold all documents' ids one after another."""
    if block % 8:
        raise ValueError("a block must be a multiple of eight ids")
    total = int(counts.sum())
    starts = np.zeros(len(docs) + 1, "<u8")
    np.cumsum(counts, out=starts[1:])
    n_blocks = -(-total // block)
    head = HEADER.size + 16 * len(docs) + 8 * len(starts) + 8 * (n_blocks + 1)
    offsets = head + np.arange(n_blocks + 1, dtype="<u8") * (block * bits // 8)
    offsets[-1] = head + -(-total // 8) * bits
    parts = [docs.astype("<i8").tobytes(), known.astype("<u8").tobytes(), starts.tobytes(), offsets.tobytes()]
    rest = np.empty(0, "<u4")
    step = max(block, AT_ONCE // block * block)
    for piece in ids:  # packed in whole blocks, so that only these are held as wide integers
        rest = np.concatenate([rest, piece])
        whole = len(rest) // step * step
        parts += [pack(rest[at:at + step], bits) for at in range(0, whole, step)]
        rest = rest[whole:]
    body = b"".join([*parts, pack(rest, bits)])
    return HEADER.pack(MAGIC, bits, block, bucket, 0, first, total, len(docs), zlib.crc32(body)) + body


class TokenFile:
    """Random access to one file, given as bytes, memory map or memory view."""

    def __init__(self, data, check: bool = False):
        self.data = memoryview(data)
        magic, self.bits, self.block, self.bucket, _, self.first, self.n_ids, self.n_docs, crc = HEADER.unpack_from(self.data)
        if magic != MAGIC:
            raise ValueError("not a file of token ids")

        def array(kind: str, count: int) -> np.ndarray:
            nonlocal at
            at += 8 * count
            return np.frombuffer(self.data, kind, count, at - 8 * count)

        at = HEADER.size
        self.docs, self.known = array("<i8", self.n_docs), array("<u8", self.n_docs)
        self.starts = array("<u8", self.n_docs + 1).astype(np.int64)
        self.offsets = array("<u8", -(-self.n_ids // self.block) + 1).astype(np.int64)
        if len(self.data) < self.offsets[-1] or check and zlib.crc32(self.data[HEADER.size:self.offsets[-1]]) != crc:
            raise ValueError("a file of token ids is damaged")

    def ids(self, begin: int, end: int) -> np.ndarray:
        """The ids numbered `begin` to `end` (without it), counted from the file's first."""
        if not 0 <= begin <= end <= self.n_ids:
            raise IndexError(f"no ids {begin} to {end} among {self.n_ids}")
        if begin == end:
            return np.empty(0, "<u4")
        a, b = begin // self.block, -(-end // self.block)
        at = a * self.block
        found = unpack(self.data[self.offsets[a]:self.offsets[b]], self.bits, min(b * self.block, self.n_ids) - at)
        return found[begin - at:end - at]

    def document(self, place: int) -> np.ndarray:
        return self.ids(int(self.starts[place]), int(self.starts[place + 1]))


# --- writing ---------------------------------------------------------------------------------------

class _Cuts:
    """Which bucket (id, tie) falls in, given the first pairs of all buckets but one, in order; null ids are last.

    Equal pairs that begin several buckets are dealt to them in turn: which of equal rows comes first makes no difference.
    """

    def __init__(self, pairs: list[tuple[int | None, int]]):
        self.ids = np.array([i for i, _ in pairs if i is not None], np.int64)
        self.ties = np.array([t for _, t in pairs], np.int64)
        self.dealt: dict[int, int] = {}

    def __call__(self, ids: pa.Array, ties: np.ndarray) -> np.ndarray:
        missing = np.asarray(ids.is_null())
        own = np.asarray(pa.compute.fill_null(ids, 0), np.int64)
        low, high = (np.searchsorted(self.ids, own, side) for side in ("left", "right"))
        low[missing], high[missing] = len(self.ids), len(self.ties)
        for a in np.unique(low[high > low]):  # ids that are the first of several buckets
            here = np.flatnonzero((low == a) & (high > low))
            cuts = self.ties[a:high[here[0]]]
            first, last = (a + np.searchsorted(cuts, ties[here], side) for side in ("left", "right"))
            low[here] = last
            for row in here[last - first > 1]:
                k = low[row] - (last - first)[here == row][0]
                turn = self.dealt[k] = self.dealt.get(k, -1) + 1
                low[row] -= turn % (low[row] - k)
        return low.astype(np.int32)


def _tokenized(id: str, text: str, path: str, size: int, pairs: list):
    """Documents with their bucket and their ids, each in as many whole bytes as the largest needs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, cuts = word_ids(path), _Cuts(pairs)
        closing = np.array([CLOSING], "<u4").tobytes()
        for batch in text_slices(batches, text):
            docs = pa.compute.struct_field(batch.column("doc"), id).cast(pa.int64())
            whole = [ids_of(t or "") + closing for t in text_of(batch, text).to_pylist()]
            ends = np.cumsum([0, *map(len, whole)]) // 4
            wide = b"".join(whole)
            if size == 2:
                narrow = np.frombuffer(wide, "<u4").astype("<u2").tobytes()
            else:
                narrow = np.frombuffer(wide, np.uint8).reshape(-1, 4)[:, :size].tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(cuts(docs, np.asarray(batch.column("tie"), np.int64))), docs, batch.column("tie"),
                 pa.array(np.diff(ends)), pa.array([narrow[a * size:b * size] for a, b in zip(ends, ends[1:])], pa.binary())],
                ["bucket", "id", "tie", "n_tokens", "ids"])

    return run


def _wide(column: pa.Array, size: int) -> np.ndarray:
    column = pa.concat_arrays([column]).cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    narrow = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].reshape(-1, size)
    out = np.zeros((len(narrow), 4), np.uint8)
    out[:, :size] = narrow
    return out.view("<u4").ravel()


def _files(size: int, bits: int, block: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, at, held, n_held = None, 0, [], 0

        def closed() -> Iterator[pa.RecordBatch]:
            nonlocal at, held, n_held
            if held:
                docs, known, counts = (np.concatenate([h[k] for h in held]) for k in range(3))
                made = file_of(docs, known, counts, [h[3] for h in held], bucket, at, bits, block)
                at, held, n_held = at + n_held, [], 0
                yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], ["file"])

        for batch in batches:
            buckets = np.asarray(batch.column("bucket"))
            counts = np.asarray(batch.column("n_tokens"), np.int64)
            row = 0
            while row < len(buckets):
                if buckets[row] != bucket:
                    yield from closed()
                    bucket, at = int(buckets[row]), 0
                ends = np.cumsum(counts[row:])
                to = row + int(np.searchsorted(ends, most - n_held)) + 1
                to = min(to, row + int(np.searchsorted(buckets[row:], bucket, "right")))
                ids = batch.column("id").slice(row, to - row)
                held.append((np.asarray(pa.compute.fill_null(ids, 0), np.int64), np.asarray(ids.is_valid()),
                             counts[row:to], _wide(batch.column("ids").slice(row, to - row), size)))
                n_held += int(counts[row:to].sum())
                if n_held >= most:
                    yield from closed()
                row = to
        yield from closed()

    return run


def _drawn(rows: DataFrame, n: int, wanted: int) -> list[tuple]:
    """About `wanted` of n rows, in order, nulls last."""
    found = rows.sample(min(1.0, wanted / max(1, n)), seed=1).collect()
    return sorted(map(tuple, found), key=lambda p: [(v is None, v or 0) for v in p])


def _cut(docs: DataFrame, n: int, n_buckets: int) -> list[tuple[int | None, int]]:
    """The first (id, tie) of all buckets but one. Ties are looked at only where one id begins several buckets."""
    wanted = min(SAMPLE, SAMPLES * n_buckets)
    drawn = _drawn(docs.select("id"), n, wanted) if n_buckets > 1 else []
    if not drawn:
        return []
    ids = [drawn[k * len(drawn) // n_buckets][0] for k in range(1, n_buckets)]
    pairs = []
    for value in dict.fromkeys(ids):
        times, ties = ids.count(value), [(-1 << 63,)]
        if times > 1:
            same = docs.where(F.col("id").eqNullSafe(F.lit(value).cast("long")))
            ties = _drawn(same.select("tie"), sum(i == value for i, in drawn) * n // len(drawn), SAMPLES * times) or ties
        pairs += [(value, ties[k * len(ties) // times][0]) for k in range(times)]
    return pairs


def written(docs: DataFrame, tokenizer_path: str, id: str = "doc_id", text: str = "text", path: str | None = None,
            file_ids: int = FILE_IDS, bucket_bytes: int = BUCKET_BYTES, least_bucket_bytes: int = LEAST_BUCKET_BYTES,
            block: int = BLOCK_IDS) -> str:
    """Writes all documents; returns the folder, a new one in the checkpoint folder unless `path` names one."""
    spark = durable(docs.sparkSession)
    path = path or f"{spark.sparkContext.getCheckpointDir()}/tokens-{uuid.uuid4().hex}"
    bits = bits_for(word_ids(tokenizer_path).tokenizer.get_vocab_size())
    size = -(-bits // 8)
    rows = packed(docs, [id, text])
    own = F.col("doc").getField(text)
    rows = rows.withColumns({"tie": F.xxhash64(own), "id": F.col("doc").getField(id).cast("long")})

    seen = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length(own)), F.lit(0)).alias("bytes")).first()
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-seen.bytes // bucket_bytes))
    n_buckets = max(1, min(wanted, seen.bytes // least_bucket_bytes))
    pairs = _cut(rows, seen.n, n_buckets)

    made = rows.select("doc", "tie").mapInArrow(
        _tokenized(id, text, tokenizer_path, size, pairs), "bucket int, id long, tie long, n_tokens long, ids binary")
    dealt = made.repartitionById(n_buckets, "bucket").sortWithinPartitions(
        "bucket", F.col("id").asc_nulls_last(), "tie")
    files = dealt.drop("tie").mapInArrow(_files(size, bits, block, file_ids), "file binary")
    # A record of one column is written as it is, so that a file is the bytes of its one record.
    files.select(F.col("file").cast("string")).write.option("maxRecordsPerFile", 1).text(f"{path}/ids")

    heads = [HEADER.unpack(r.head) for r in _opened(spark, path).select(
        F.substring("content", 1, HEADER.size).alias("head")).collect()]  # one for each file
    lengths = Counter()
    for _, _, _, bucket, _, _, n_ids, _, _ in heads:
        lengths[bucket] += n_ids
    firsts = dict(zip(sorted(lengths), accumulate([0, *(lengths[k] for k in sorted(lengths))])))
    table = [(k, firsts[k], lengths[k], bits) for k in sorted(lengths)]
    spark.createDataFrame(table, "bucket int, first long, n_ids long, bits int").coalesce(1).write.parquet(f"{path}/buckets")
    return path


# --- reading ---------------------------------------------------------------------------------------

def _opened(spark: SparkSession, path: str, names: str = "part-*") -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", names).load(f"{path}/ids")
    return files.where("length > 0").select("content")


def _rows(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Little-endian 32-bit ids as one binary value for each stretch between the ends."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [
        None, pa.py_buffer(((ends - ends[0]) * 4).astype(np.int32)), pa.py_buffer(ids.tobytes())])


def _firsts(spark: SparkSession, path: str) -> dict[int, int]:
    """The number of each bucket's first id."""
    return {r.bucket: r.first for r in spark.read.parquet(f"{path}/buckets").select("bucket", "first").collect()}


def documents(spark: SparkSession, path: str, id: str = "doc_id") -> DataFrame:
    """All documents of the files: id, number of the first id, number of ids, and the ids as little-endian u32."""
    firsts = _firsts(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column("content"):
                file, at = TokenFile(value.as_buffer(), check=True), 0
                while at < file.n_docs:
                    to = int(np.searchsorted(file.starts, file.starts[at] + AT_ONCE, "right")) - 1
                    to = min(max(to, at + 1), file.n_docs)
                    ends = file.starts[at:to + 1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(file.docs[at:to], mask=file.known[at:to] == 0), pa.array(firsts[file.bucket] + file.first + ends[:-1]),
                         pa.array(np.diff(ends)), _rows(file.ids(int(ends[0]), int(ends[-1])), ends)],
                        [id, "start", "n_tokens", "ids"])
                    at = to

    return _opened(spark, path).mapInArrow(run, f"`{id}` long, start long, n_tokens long, ids binary")


def ids_between(spark: SparkSession, path: str, begin: int, end: int) -> DataFrame:
    """The ids numbered `begin` to `end` (without it) over all files, as stretches (first, ids). Only files of buckets that
    overlap are opened, and only blocks that overlap are unpacked."""
    hit = spark.read.parquet(f"{path}/buckets").where((F.col("first") < end) & (F.col("first") + F.col("n_ids") > begin))
    firsts = {r.bucket: r.first for r in hit.select("bucket", "first").collect()}
    names = [f"part-{bucket:05d}-*" for bucket in firsts]  # a task's files have its number

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column("content"):
                file = TokenFile(value.as_buffer())
                first = firsts[file.bucket] + file.first
                a, b = max(begin, first), min(end, first + file.n_ids)
                for at in range(a, b, AT_ONCE):
                    to = min(b, at + AT_ONCE)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([at], pa.int64()), _rows(file.ids(at - first, to - first), np.array([at, to]))],
                        ["first", "ids"])

    return _opened(spark, path, "{" + ",".join(names or ["none"]) + "}").mapInArrow(run, "first long, ids binary")
