"""Vectors as exact integers, numbered rows, and queries sent to blocks of vectors.

A component x becomes floor(scale * x), x as double, for a scale that is a power of two. Arrays are
int64 where that holds the values, else Python's integers, so no finite component is lost.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tasks that blocks are dealt to; more blocks share them.
MOST_PARTS = 10_000

LEAST, MOST = -(2**63), 2**63 - 1


def is_finite(vector: str = "embedding") -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = F.forall(
        vector,
        lambda x: F.coalesce(
            ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))), F.lit(False)
        ),
    )
    return F.coalesce(finite, F.lit(False))


def numbered(vectors: DataFrame) -> DataFrame:
    """With ``row``, a number of its own for each row. Stage the frame before it is read twice."""
    return vectors.withColumn("row", F.monotonically_increasing_id())


def _floor(x: float, scale: int) -> int:
    # A double of 2**53 or more is whole.
    return int(x) * scale if abs(x) >= 2**53 else math.floor(x * scale)


def floors(values: np.ndarray, scale: int) -> np.ndarray:
    values = values.astype(np.float64)
    if np.abs(values).max(initial=0) < 2**62 / scale:
        return np.floor(values * scale).astype(np.int64)
    return np.array([_floor(x, scale) for x in values.tolist()], object)


def matrix(column: pa.Array | pa.ChunkedArray, scale: int) -> np.ndarray:
    """Vectors of one length, a row each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = floors(column.flatten().to_numpy(zero_copy_only=False), scale)
    return flat.reshape(n, len(flat) // n if n else 0)


def largest(values: np.ndarray) -> float:
    return max(map(abs, (float(values.max(initial=0)), float(values.min(initial=0)))))


def gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Batches put together to at least ``rows`` rows, so that numpy works on long arrays."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def send_to_blocks(
    vectors: DataFrame,
    queries: DataFrame,
    block_rows: int,
    meet: Callable[[pa.Table, Iterator[pa.Table]], Iterator[pa.RecordBatch]],
    schema: str,
    query_rows: int = 256,
) -> DataFrame:
    """``meet(block, queries)`` for every block of about ``block_rows`` vectors and the queries of
    the same length, a stretch of ``query_rows`` or more at a time.

    Both frames have the columns row, size (of the vector) and whatever ``meet`` reads. A vector
    goes to one block and stays there; every query is sent to all blocks and streams past. A task
    holds one block and one stretch of queries. Rows are dealt by their number, so that no id,
    label or repeated vector makes a block larger.
    """
    blocks = max(1, -(-vectors.count() // block_rows))
    own = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    sent = vectors.select(own.alias("block"), F.lit(False).alias("asks"), "*").unionByName(
        queries.select(every.alias("block"), F.lit(True).alias("asks"), "*")
    )
    keys = ["block", "size"]
    # Several tasks for a block, most of them empty, so that few blocks seldom share one.
    dealt = sent.repartition(min(8 * blocks, MOST_PARTS), *keys).sortWithinPartitions(
        *keys, "asks"
    )

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
        """Stretches of one block, size and kind, in order."""
        for batch in batches:
            if not batch.num_rows:
                continue
            key = [batch.column(c).to_numpy(zero_copy_only=False) for c in (*keys, "asks")]
            new = np.zeros(batch.num_rows - 1, bool)
            for values in key:
                new |= values[1:] != values[:-1]
            ends = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
            for start, end in zip(ends, ends[1:]):
                yield tuple(int(v[start]) for v in key), batch.slice(start, end - start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = runs(batches)
        held = next(stream, None)
        while held:
            block, parts = held[0][:2], []
            while held and held[0] == (*block, 0):
                parts.append(held[1])
                held = next(stream, None)

            def asking() -> Iterator[pa.RecordBatch]:
                nonlocal held
                while held and held[0] == (*block, 1):
                    yield held[1]
                    held = next(stream, None)

            if parts:
                vectors = pa.Table.from_batches(parts).combine_chunks()
                yield from meet(vectors, gathered(asking(), query_rows))
            # Queries of a length that no vector of the block has, or that were left unread.
            for _ in asking():
                pass

    return dealt.mapInArrow(run, schema)
