"""Vector code compression: product quantisation with equal-average nearest-entry search.

Vectors are cut into 16 consecutive parts. Each part position has a codebook of at most 64 entries,
which starts as that part of the vectors of the 64 smallest ids. A round assigns every part to its
nearest entry and replaces each entry by the floor of its parts' mean; an unused one stays.

Nearest entries are found by equal-average search: a book's entries are sorted by the sum of their
components, and from the place of a part's own sum the search goes outwards on both sides. As
(sum of part - sum of entry)**2 is at most the dimension times their squared distance, a side ends
where that gap strictly exceeds the dimension times the best distance. Ties go to the lower index.

All numbers are integers: floor(256 x) of a component x as double. Sums travel in limbs of 32 bits,
so they are exact at any size and number of rows. The driver holds the books alone, 64 entries of
the vectors' length.

Rows whose vector is null, or holds null or non-finite components, take no part. Vectors shorter
than the longest, or than the next multiple of 16, count as filled with zeros. Rows without an id
are coded, but start no entry. Repeated rows each count, each starting an entry among the first.
An error beyond a long is null, as is then the sum of its label. Other columns are not read. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import remove_staged, staged, staged_so_far
from earshot.llm.vectors import MOST, floors, gathered, is_finite, largest

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256

# Rows searched at a time.
ROWS = 4096

# Labels whose sums are broadcast when the rows are given them.
BROADCAST_LABELS = 100_000

_MASK = 2**32 - 1


def cut(column: pa.Array | pa.ChunkedArray, length: int) -> np.ndarray:
    """(rows, 16, length / 16) integers, short vectors filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = floors(column.flatten().to_numpy(zero_copy_only=False), SCALE)
    if (sizes != length).any():
        filled = np.zeros((len(sizes), length), flat.dtype)
        filled[np.arange(length)[None, :] < sizes[:, None]] = flat
        flat = filled
    return flat.reshape(len(sizes), PARTS, length // PARTS)


class Books:
    """The codebooks of all part positions, sorted by component sum."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        self._in(entries.dtype)

    def _in(self, kind: np.dtype) -> None:
        entries = self.entries.astype(kind)
        parts, k, dim = entries.shape
        sums = entries.sum(axis=2)
        self.order = np.argsort(sums, axis=1, kind="stable")
        self.sums = np.take_along_axis(sums, self.order, axis=1)
        self._sorted = np.take_along_axis(entries, self.order[:, :, None], axis=1)
        self._sorted = self._sorted.reshape(parts * k, dim)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, 16) indexes and squared distances of (rows, 16, dim) parts."""
        count, k, dim = self.entries.shape
        most = max(largest(parts), largest(self.entries))
        kind = np.dtype(np.int64) if 2 * most * max(dim, 1) < 2**31 else np.dtype(object)
        if self._sorted.dtype != kind:
            self._in(kind)
        rows = parts.astype(kind).reshape(len(parts) * count, dim)
        sums = rows.sum(axis=1)
        place = np.tile(np.arange(count), len(parts))
        start = np.empty(len(rows), np.int64)
        for p in range(count):
            start[p::count] = np.searchsorted(self.sums[p], sums[p::count])
        start += place * k
        all_sums, order = self.sums.reshape(-1), self.order.reshape(-1)
        distance = np.full(len(rows), MOST if kind == np.int64 else 1 << 4096, kind)
        # The gap that a side may have: the dimension times the best distance so far.
        reach = distance.copy()
        index = np.full(len(rows), k)
        # Upwards and downwards: the rows still searching, where each is, and where it must end.
        sides = [
            (1, np.arange(len(rows)), start, (place + 1) * k),
            (-1, np.arange(len(rows)), start - 1, place * k - 1),
        ]
        while any(len(side[1]) for side in sides):
            for n, (step, who, at, end) in enumerate(sides):
                inside = at != end
                who, at, end = who[inside], at[inside], end[inside]
                near = (sums[who] - all_sums[at]) ** 2 <= reach[who]
                who, at, end = who[near], at[near], end[near]
                gaps = rows[who] - self._sorted[at]
                found, entry = (gaps * gaps).sum(axis=1), order[at]
                old = distance[who]
                better = (found < old) | ((found == old) & (entry < index[who]))
                who_better = who[better]
                distance[who_better], index[who_better] = found[better], entry[better]
                reach[who_better] = found[better] * dim
                sides[n] = (step, who, at + step, end)
        return index.reshape(-1, count), distance.reshape(-1, count)

    def sha256(self) -> str:
        numbers = ",".join(str(int(x)) for x in self.entries.reshape(-1))
        return hashlib.sha256(numbers.encode()).hexdigest()


def _limbs(value: int) -> list[int]:
    """The number in digits of 32 bits, the last of them signed."""
    digits = []
    while not -(2**31) <= value < 2**31:
        digits.append(value & _MASK)
        value >>= 32
    return [*digits, value]


def _sums(kept: DataFrame, books: Books, length: int) -> dict[int, int]:
    """Per entry, the components' sums and the count, of the parts assigned to it."""
    count, k, dim = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((count * k, dim + 1), object)
        for batch in gathered(batches, ROWS):
            parts = cut(batch.column("embedding"), length)
            index, _ = books.nearest(parts)
            entry = (index + np.arange(count) * k).reshape(-1)
            rows = np.ones((len(entry), dim + 1), parts.dtype)
            rows[:, :dim] = parts.reshape(len(entry), dim)
            if largest(rows) < 2**31:
                batch_sums = np.zeros((count * k, dim + 1), np.int64)
                np.add.at(batch_sums, entry, rows)
                totals += batch_sums
            else:
                np.add.at(totals, entry, rows.astype(object))
        out = [
            (place, limb, digit)
            for place, total in enumerate(totals.reshape(-1).tolist())
            for limb, digit in enumerate(_limbs(total))
            if digit
        ]
        columns = zip(*out) if out else ([], [], [])
        kinds = (pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, kinds)],
            names=["place", "limb", "digit"],
        )

    digits = kept.select("embedding").mapInArrow(run, "place int, limb int, digit long")
    summed = digits.groupBy("place", "limb").agg(F.sum("digit").alias("digit"))
    totals: dict[int, int] = {}
    # A few rows for each component of the books.
    for r in summed.collect():
        totals[r["place"]] = totals.get(r["place"], 0) + (r["digit"] << 32 * r["limb"])
    return totals


def train(kept: DataFrame, rounds: int = ROUNDS) -> tuple[Books, int] | None:
    """The books after ``rounds`` rounds over vec_id, embedding (none null or non-finite), and the
    length that vectors are filled up to; none if there is no vector with an id."""
    longest = kept.agg(F.max(F.size("embedding"))).first()[0]
    first = (
        kept.where(F.col("vec_id").isNotNull())
        .select("vec_id", "embedding")
        .orderBy("vec_id", "embedding")
        .limit(ENTRIES)
        .collect()
    )
    if not first:
        return None
    length = -(-longest // PARTS) * PARTS
    values = pa.array([r["embedding"] for r in first], pa.list_(pa.float64()))
    books = Books(np.ascontiguousarray(cut(values, length).transpose(1, 0, 2)))
    for _ in range(rounds):
        totals = _sums(kept, books, length)
        count, k, dim = books.entries.shape
        moved = books.entries.astype(object).reshape(count * k, dim)
        for entry in range(count * k):
            n = totals.get(entry * (dim + 1) + dim, 0)
            if n:
                moved[entry] = [totals.get(entry * (dim + 1) + j, 0) // n for j in range(dim)]
        moved = moved.reshape(count, k, dim)
        books = Books(moved.astype(np.int64) if largest(moved) < 2**62 else moved)
    return books, length


def encode(kept: DataFrame, books: Books, length: int) -> DataFrame:
    """vec_id, label, code (an entry's index per part, two hex digits each), error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, ROWS):
            index, distance = books.nearest(cut(batch.column("embedding"), length))
            errors = distance.sum(axis=1, dtype=object).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").combine_chunks(),
                    batch.column("label").combine_chunks(),
                    pa.array([bytes(x).hex() for x in index.astype(np.uint8)], pa.string()),
                    pa.array([x if x <= MOST else None for x in errors], pa.int64()),
                ],
                names=["vec_id", "label", "code", "error"],
            )

    kinds = ", ".join(f"{c} {kept.schema[c].dataType.simpleString()}" for c in ("vec_id", "label"))
    return kept.select("vec_id", "label", "embedding").mapInArrow(
        run, f"{kinds}, code string, error long"
    )


def decode(code: str, books: Books) -> np.ndarray:
    """The vector of integers that a code stands for."""
    return np.concatenate([books.entries[p, e] for p, e in enumerate(bytes.fromhex(code))])


def compress(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 of vec_id, label, embedding."""
    mark = staged_so_far()
    kept = staged(
        vectors.select("vec_id", "label", "embedding").where(is_finite()), "vectors-to-code"
    )
    found = train(kept, rounds)
    if found is None:
        found = Books(np.zeros((PARTS, 1, 0), np.int64)), 0
        kept = kept.limit(0)
    books, length = found
    coded = staged(encode(kept, books, length), "vector-codes")
    beyond = F.count_if(F.col("error").isNull()) > 0
    sums = staged(
        coded.groupBy("label").agg(
            F.when(~beyond, F.try_sum("error")).alias("label_error")
        ),
        "label-errors",
    ).withColumnRenamed("label", "_label")
    remove_staged(vectors.sparkSession, mark, coded, sums)
    if sums.count() <= BROADCAST_LABELS:
        sums = F.broadcast(sums)
    joined = coded.join(sums, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select(
        "vec_id", "label", "code", "error", "label_error",
        F.lit(books.sha256()).alias("codebooks_sha256"),
    )
