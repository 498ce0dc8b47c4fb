"""Vector codes and hard negatives."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from earshot.llm import negatives, vector_codes
from earshot.llm.common import prepare, staged
from earshot.llm.vectors import floors, numbered, send_to_blocks
from tests.llm import brute

SCHEMA = "vec_id long, embedding array<float>, label int, code string, row long, size string"
CODED = ("vec_id", "code", "error", "label_error", "codebooks_sha256")
MINED = (
    "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
)


def table(spark, rows):
    """With columns named like the operators' own."""
    prepare(spark)
    return spark.createDataFrame([(*r, "x", 7, "y") for r in rows], SCHEMA).repartition(3)


def single(vector):
    return None if vector is None else [None if x is None else float(np.float32(x)) for x in vector]


def drawn(n, dim, seed=0):
    draw = np.random.default_rng(seed)
    return [
        (i, single(np.round(draw.normal(size=dim) / 8, 2).tolist()), int(draw.integers(4)))
        for i in range(n)
    ]


ODD = [
    (1000, None, 1), (1001, [1.0, None] + [0.0] * 30, 1), (1100, [float("nan")] * 32, 2),
    (1200, [float("inf")] + [0.0] * 31, 2), (1300, [-float("inf")] * 32, 1), (1400, [], 1),
    (1500, [0.0] * 32, 1), (1501, [0.0] * 32, None), (None, [0.25] * 32, 1), (None, None, None),
    (1600, [1.0, 2.0], 1), (1601, [0.5, 0.5], 1), (1602, [1.0, 1.5], 2), (1700, [0.5] * 32, 1),
]


# --- vector codes


@pytest.mark.parametrize("dim", [16, 32, 40])
def test_codes_are_those_of_the_plain_search(spark, collected, dim, monkeypatch):
    monkeypatch.setattr(vector_codes, "ROWS", 64)
    rows = drawn(150, dim) + ([] if dim == 16 else ODD)
    rows += rows[:40]
    found = vector_codes.compress(table(spark, rows))
    assert collected(found, *CODED) == sorted(brute.vector_codes(rows), key=repr)


@pytest.mark.parametrize("bound", [100_000, 0])
def test_labels_without_broadcast(spark, collected, monkeypatch, bound):
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", bound)
    rows = drawn(90, 16) + [(200 + n, [0.5] * 16, None) for n in range(30)]
    found = vector_codes.compress(table(spark, rows))
    assert collected(found, *CODED) == sorted(brute.vector_codes(rows), key=repr)


def test_huge_components_are_exact(spark, collected):
    rows = drawn(80, 16) + [(500, single([3e38] * 16), 1), (501, single([-4e7] * 16), 2)]
    rows += [(502, single([4e7, 1e12] * 8), 2), (3, single([1e9] * 16), None)]
    found = vector_codes.compress(table(spark, rows))
    expected = brute.vector_codes(rows)
    assert collected(found, *CODED) == sorted(expected, key=repr)
    assert any(r[2] is None for r in expected) or max(r[2] for r in expected) > 2**40


def test_nothing_to_code(spark):
    for rows in ([], [(1, None, 2)]):
        found = vector_codes.compress(table(spark, rows))
        assert found.count() == 0 and set(CODED) <= set(found.columns)


def test_fewer_vectors_than_entries_and_decoding(spark, collected):
    rows = drawn(5, 32)
    kept = table(spark, rows)
    books, length = vector_codes.train(kept)
    coded = vector_codes.encode(kept, books, length).collect()
    # Every vector starts an entry of its own, so none has an error.
    assert len(coded) == 5 and all(r["error"] == 0 for r in coded)
    for r in coded:
        vector = floors(np.array(rows[r["vec_id"]][1]), 256)
        assert (vector_codes.decode(r["code"], books) == vector).all()


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_the_search_finds_the_nearest_entry(data):
    dim = data.draw(st.integers(0, 3))
    number = st.integers(-5, 5) if data.draw(st.booleans()) else st.integers(-(2**40), 2**40)
    k, n = data.draw(st.integers(1, 9)), data.draw(st.integers(1, 6))
    values = data.draw(
        st.lists(number, min_size=2 * (n + k) * dim, max_size=2 * (n + k) * dim)
    )
    entries = np.array(values[: 2 * k * dim], np.int64).reshape(2, k, dim)
    parts = np.array(values[2 * k * dim :], np.int64).reshape(n, 2, dim)
    index, distance = vector_codes.Books(entries).nearest(parts)
    for i in range(n):
        for p in range(2):
            plain = [
                (sum((int(a) - int(b)) ** 2 for a, b in zip(parts[i, p], e)), j)
                for j, e in enumerate(entries[p])
            ]
            assert (int(distance[i, p]), int(index[i, p])) == min(plain)


def test_the_search_leaves_entries_out():
    """With sums far apart only the entries beside the part's sum are compared."""

    entries = np.arange(64)[None, :, None] * np.full((1, 1, 4), 1000)
    books = vector_codes.Books(entries)
    read = []

    class Watched:
        dtype = books._sorted.dtype

        def __init__(self, values):
            self.values = values

        def __getitem__(self, at):
            read.append(len(at))
            return self.values[at]

    books._sorted = Watched(books._sorted)
    index, _ = books.nearest(np.full((10, 1, 4), 20_010))
    assert (index == 20).all() and sum(read) <= 30


@settings(max_examples=100, deadline=None)
@given(st.integers(-(2**200), 2**200))
def test_limbs_are_the_number(value):
    limbs = vector_codes._limbs(value)
    assert sum(x << 32 * n for n, x in enumerate(limbs)) == value
    assert all(-(2**63) <= x < 2**63 for x in limbs)


# --- hard negatives


def test_negatives_are_those_of_all_scores(spark, collected, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 40)
    rows = drawn(350, 32) + ODD + [(100, single([0.1] * 32), 1)]
    rows += [(n, single([0.1] * 32), n % 3) for n in range(600, 640)] + ODD[-4:]
    found = negatives.mine(table(spark, rows), F.col("vec_id") % 100 == 0)
    assert collected(found, *MINED) == sorted(brute.hard_negatives(rows), key=repr)


def test_scores_near_and_beyond_a_long(spark, collected):
    rows = drawn(130, 4) + [
        (200, single([4e7, 0.0, 0.0, 1.0]), 1), (201, single([4e7, 0.0, 1.0, 0.0]), 1),
        (202, single([3.5e7, 1.0, 0.0, 0.0]), 2), (300, single([3e38] * 4), 0),
        (301, single([2e38] * 4), 0), (302, single([-3e38] * 4), 0), (303, single([1e38] * 4), 2),
    ]
    found = negatives.mine(table(spark, rows), F.col("vec_id") % 100 == 0)
    expected = brute.hard_negatives(rows)
    assert collected(found, *MINED) == sorted(expected, key=repr)
    assert any(r[4] == 2**63 - 1 for r in expected)


def test_no_anchors_and_no_vectors(spark):
    rows = drawn(20, 4)
    assert negatives.mine(table(spark, rows), F.lit(False)).count() == 0
    assert negatives.mine(table(spark, []), F.col("vec_id") % 100 == 0).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 40), st.integers(0, 40), st.integers(0, 40), st.integers(1, 5))
def test_strassen_is_the_product(m, d, n, leaf):
    draw = np.random.default_rng(m * 1681 + d * 41 + n)
    a, b = draw.integers(-(2**25), 2**25, (m, d)), draw.integers(-(2**25), 2**25, (d, n))
    assert (negatives.strassen(a, b, leaf) == a @ b).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-4, 4), max_size=30), st.integers(1, 6))
def test_heaps_merge(values, k):
    values = np.array(values, np.int64)
    whole = negatives.heap(values, np.arange(len(values)), k)
    cut = len(values) // 2
    parts = [negatives.heap(values, np.arange(len(values))[s], k) for s in
             (slice(cut), slice(cut, None))]
    assert negatives.heap(values, np.concatenate(parts), k).tolist() == whole.tolist()
    assert whole.tolist() == sorted(range(len(values)), key=lambda i: (-values[i], i))[:k]


def test_blocks_stay_bounded_when_an_id_repeats(spark):
    prepare(spark)
    df = spark.range(3000).select(F.lit(7).alias("vec_id"), F.lit(2).alias("size"))

    def meet(block, asking):
        import pyarrow as pa

        asked = sum(t.num_rows for t in asking)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block.num_rows]), pa.array([asked])], names=["held", "asked"]
        )

    rows = staged(numbered(df).select("row", "size", "vec_id"), "numbered")
    met = send_to_blocks(rows, rows.limit(50), 300, meet, "held long, asked long").collect()
    sizes = [r["held"] for r in met]
    assert sum(sizes) == 3000 and len(sizes) == 10 and max(sizes) < 450
    assert all(r["asked"] == 50 for r in met)
