"""Vector codes against full scans over plain integers."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plaudit.llm import codes
from plaudit.llm.registry import LLM_QUERIES

FIELDS = "vec_id long, embedding array<double>, label int, doc string, code string, far string"


def plain(rows, parts=8, entries=16, rounds=6, scale=4096):
    """(id, codes, error) of each kept row in order, and the final codebooks, by comparing everything with everything."""
    kept = [(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], []
    width = len(kept[0][1]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def far(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def nearest():
        return [[min((far(c[p], e), k) for k, e in enumerate(books[p])) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        found = nearest()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [c[p] for c, f in zip(cut, found) if f[p][1] == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own)]
    found = nearest()
    return [(i, tuple(k for _, k in f), min(sum(d for d, _ in f), (1 << 63) - 1)) for (i, _), f in zip(kept, found)], books


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def check(spark, rows, **how):
    made = spark.createDataFrame([(i, v, None, "x", "y", "z") for i, v in rows], FIELDS)
    found = codes.coded(made, carry=["label", "doc", "code", "far"], **how)
    got = found.rows.collect()
    assert all((r.doc.doc, r.doc.code, r.doc.far) == ("x", "y", "z") for r in got)
    want, books = plain(rows, **how)
    assert ordered((r.doc.vec_id, tuple(r.code), r.error) for r in got) == ordered(want)
    assert found.entries.tolist() == books
    return got


def test_hard_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), (rng.integers(-9, 9, 8) / 4096 / rng.integers(1, 3)).tolist()) for i in rng.permutation(90)]
    rows += [(90, None), (91, [1.0] * 7 + [None]), (92, [float("nan")] + [0.0] * 7), (93, [float("-inf")] * 8),
             (94, [0.0] * 8), (95, [0.0] * 8), (95, [0.0] * 8), (96, [-1e-9] * 8), (None, [0.5] * 8), (3, [0.25] * 8)]
    check(spark, rows, parts=4, entries=5)
    check(spark, rows, parts=8, entries=300, rounds=2)  # fewer rows than entries


def test_far_apart(spark):
    """Components whose squares do not fit in 53, or in 63, bits; an error stops at the largest long."""
    for size in (2.0 ** 9, 2.0 ** 15, 2.0 ** 24):
        rows = [(i, [size * ((i * 7 + k) % 11 - 5) + i for k in range(4)]) for i in range(24)]
        check(spark, rows, parts=2, entries=4, rounds=3)


def test_past_long(spark):
    rows = [(i, [1e300 * (-1) ** i, 0.0]) for i in range(3)]
    made = spark.createDataFrame([(i, v, None, "", "", "") for i, v in rows], FIELDS)
    got = {r.doc.vec_id: r.error for r in codes.coded(made, parts=1, entries=1, rounds=1).rows.collect()}
    assert set(got) == {0, 1, 2} and max(got.values()) == (1 << 63) - 1


def test_other_lengths(spark):
    rows = [(1, [0.0] * 4), (2, [1.0] * 4), (3, [0.0] * 3), (4, []), (5, [0.0] * 8)]
    made = spark.createDataFrame([(i, v, None, "", "", "") for i, v in rows], FIELDS)
    assert sorted(r.doc.vec_id for r in codes.coded(made, parts=4).rows.collect()) == [1, 2]


def test_nothing(spark):
    for rows in ([], [(1, None)], [(1, [])]):
        found = codes.coded(spark.createDataFrame([(i, v, 1, "", "", "") for i, v in rows], FIELDS), carry=["label"])
        assert found.rows.count() == 0 and found.entries.size == 0
        assert codes.with_label_error(found.rows, "label").count() == 0


@given(st.lists(st.lists(st.integers(-3, 3), min_size=2, max_size=2), min_size=1, max_size=30), st.data())
@settings(max_examples=200, deadline=None)
def test_active_entries(rows, data):
    """Comparing moved entries alone gives what a full scan gives, lower indices first, with fewer comparisons."""
    parts = np.array(rows)
    old = np.array(data.draw(st.lists(st.lists(st.integers(-3, 3), min_size=2, max_size=2), min_size=5, max_size=5)))
    new = old.copy()
    for k in data.draw(st.sets(st.integers(0, 4), max_size=4)):
        new[k] = data.draw(st.lists(st.integers(-3, 3), min_size=2, max_size=2))
    moved = (old != new).any(1)
    code, far, _ = codes.assign(parts, old, np.ones(5, bool), None, None)
    code, far, compared = codes.assign(parts, new, moved, code, far)
    want, want_far, full = codes.assign(parts, new, moved, None, None)
    assert code.tolist() == want.tolist() and far.tolist() == want_far.tolist()
    assert compared <= full and (moved.any() or compared == 0)


def test_label_error(spark):
    rows = spark.createDataFrame([((1, "a"), 3), ((2, None), 4), ((3, "a"), 5), ((4, None), (1 << 63) - 1)],
                                 "doc struct<vec_id: long, label: string>, error long")
    got = {r.doc.vec_id: r.label_error for r in codes.with_label_error(rows, "label").collect()}
    assert got == {1: 8, 2: (1 << 63) - 1, 3: 8, 4: (1 << 63) - 1}


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    want, _ = plain([tuple(r) for r in rows])
    got = [(r.vec_id, tuple(bytes.fromhex(r.code)), r.error) for r in LLM_QUERIES["op11_vector_codes"](spark, sf_dir).collect()]
    assert ordered(got) == ordered(want)


@pytest.mark.parametrize("count", [0, 1, 5])
def test_binary_columns(count):
    rows = np.arange(count * 6, dtype="<i4").reshape(count, 6)
    assert codes._flat(codes._binary(rows), "<i4", 6).tolist() == rows.tolist()
