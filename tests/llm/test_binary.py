"""Bit-packed files as exact round trips."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plaudit.llm import binary
from plaudit.llm.registry import LLM_QUERIES, tokenizer

pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def path():
    return tokenizer("word_bpe_49k.json")


@pytest.fixture(scope="module")
def ids_of(path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    return lambda text: [*library.encode(text or "", add_special_tokens=False).ids, 1]


@given(st.integers(1, 32), st.data())
@settings(max_examples=300, deadline=None)
def test_bits(bits, data):
    ids = np.array(data.draw(st.lists(st.integers(0, (1 << bits) - 1), max_size=70)), "<u4")
    packed = binary.pack(ids, bits)
    assert len(packed) == -(-len(ids) // 8) * bits
    assert binary.unpack(packed, bits, len(ids)).tolist() == ids.tolist()
    whole = int.from_bytes(packed, "little")  # id k stands in the bits from k * bits on
    assert [whole >> k * bits & (1 << bits) - 1 for k in range(len(ids))] == ids.tolist()


def test_width():
    assert [binary.bits_for(n) for n in (1, 2, 3, 256, 257, 49408, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]
    with pytest.raises(ValueError):
        binary.pack(np.array([8], "<u4"), 3)


@given(st.lists(st.integers(0, 40), max_size=12), st.integers(3, 20), st.data())
@settings(max_examples=200, deadline=None)
def test_file(counts, bits, data):
    rng = np.random.default_rng(len(counts))
    ids = [rng.integers(0, 1 << bits, n).astype("<u4") for n in counts]
    made = binary.file_of(np.arange(len(counts)) - 2, np.arange(len(counts)) % 2, np.array(counts, np.int64), ids, 3,
                          77, bits, 16)
    file, whole = binary.TokenFile(made + b"\n", check=True), np.concatenate([np.empty(0, "<u4"), *ids])
    assert (file.bucket, file.first, file.n_ids, file.n_docs, file.bits) == (3, 77, len(whole), len(counts), bits)
    assert file.docs.tolist() == [k - 2 for k in range(len(counts))]
    for k, own in enumerate(ids):
        assert file.document(k).tolist() == own.tolist()
    a = data.draw(st.integers(0, len(whole)))
    b = data.draw(st.integers(a, len(whole)))
    assert file.ids(a, b).tolist() == whole[a:b].tolist()
    with pytest.raises(IndexError):
        file.ids(0, len(whole) + 1)
    if len(whole):
        damaged = bytearray(made)
        damaged[-1] ^= 1
        with pytest.raises(ValueError):
            binary.TokenFile(bytes(damaged), check=True)
        with pytest.raises(ValueError):
            binary.TokenFile(made[:-1])


def by_order(table):
    return sorted(table, key=lambda r: (r[0] is None, r[0] or 0))


def check(spark, files, table, ids_of):
    """Rows tell their documents; stretches are gapless in the order of the ids."""
    got = binary.documents(spark, files).collect()
    own = [(i, ids_of(t)) for i, t in table]
    assert Counter((r.doc_id, bytes(r.ids)) for r in got) == Counter(
        (i, np.array(ids, "<u4").tobytes()) for i, ids in own)
    got.sort(key=lambda r: r.start)
    at = 0
    for r in got:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens
        at += r.n_tokens
    assert [r.doc_id for r in got] == [i for i, _ in by_order(table)]
    return b"".join(bytes(r.ids) for r in got)


def test_hard_corpus(spark, docs, corpus, path, ids_of):
    for sizes in ({}, {"file_ids": 100, "least_bucket_bytes": 2000, "block": 8}, {"file_ids": 1, "least_bucket_bytes": 1}):
        files = binary.written(docs, path, **sizes)
        whole = check(spark, files, corpus, ids_of)
        for a, b in ((0, len(whole) // 4), (5, 6), (1000, 4321), (700, 700)):
            rows = sorted(binary.ids_between(spark, files, a, b).collect())
            assert b"".join(bytes(r.ids) for r in rows) == whole[4 * a:4 * b]


def test_stretch_opens_few_files(spark, docs, path):
    files = binary.written(docs, path, file_ids=200, least_bucket_bytes=2000)
    buckets = {r.bucket: r for r in spark.read.parquet(f"{files}/buckets").collect()}
    assert len(buckets) > 2 and {r.bits for r in buckets.values()} == {16}
    last = buckets[max(buckets)]
    rows = binary.ids_between(spark, files, last.first, last.first + 1)
    opened = {name.rsplit("/", 1)[1][:10] for name in rows.inputFiles()}
    assert opened == {f"part-{last.bucket:05d}"}


def test_repeated_rows_share_out(spark, path):
    """A third of all rows is one row."""
    rows = [(7, "the same text")] * 400 + [(k, f"text {k}") for k in range(800)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    files = binary.written(table, path, least_bucket_bytes=64)
    spark.conf.set("spark.sql.shuffle.partitions", before)
    buckets = spark.read.parquet(f"{files}/buckets").collect()
    assert len(buckets) == 12 and max(r.n_ids for r in buckets) < 0.25 * sum(r.n_ids for r in buckets)
    got = binary.documents(spark, files).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == sorted(i for i, _ in rows)


def test_cuts():
    cuts = binary._Cuts([(3, 5), (3, 9), (4, 0), (None, -2), (None, 8)])
    ids = pa.array([None, 2, 3, 3, 3, 3, 4, 5, None, None, None], pa.int64())
    ties = np.array([-3, 0, 4, 5, 8, 9, -1, 0, -2, 7, 8])
    assert cuts(ids, ties).tolist() == [3, 0, 0, 1, 1, 2, 2, 3, 4, 4, 5]


def test_equal_rows_take_turns():
    """Rows before and after them keep their order."""
    cuts = binary._Cuts([(3, 5), (3, 5), (3, 5), (3, 7)])
    ids = pa.array([3] * 8 + [2, 9])
    assert cuts(ids, np.array([5, 5, 4, 5, 5, 6, 5, 7, 0, 0])).tolist() == [3, 2, 0, 1, 3, 3, 2, 4, 0, 4]


def test_nothing(spark, nothing, path):
    files = binary.written(nothing, path)
    assert binary.documents(spark, files).count() == 0
    assert binary.ids_between(spark, files, 0, 10).count() == 0


def test_query(spark, sf_dir, ids_of):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want, at = {}, 0
    for i, text in by_order([tuple(r) for r in table]):
        ids = ids_of(text)
        want[i] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    got = LLM_QUERIES["op12_binary_tokens"](spark, sf_dir).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got} == want
