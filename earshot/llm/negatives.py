"""Hard-negative mining: exact scores by Strassen's multiplication, kept in mergeable heaps.

Vectors stay in blocks; the anchors are sent to every block and stream past it. A stretch of anchors
meets a block in square tiles of int64, multiplied by Strassen's recursion: tiles with an odd side
are filled up with zeros, seven products of halves and exact integer additions take the place of
eight products, and small ones are multiplied directly. Sums are exact modulo 2**64 at every step,
so they are exact where the scores are below 2**63.

There are two passes. The first scores anchors against vectors of the same label and keeps, per
anchor, a heap of the best. Heaps of two blocks merge into the best of both; Spark merges them by a
grouped limit before and after the shuffle. In the second pass each positive score opens a window
(80 % to 100 % of it) with a heap of its own over vectors of other labels, merged alike.

Components x become floor(256 x), x as double. Rows with a null label, a null vector, or null or
non-finite components take no part; vectors of another length than the anchor's aren't its
candidates. Scores that might pass 2**63 are computed in Python's integers, and one beyond a long
counts as the nearest long. Rows without an id are candidates, after all others in ties. Repeated
rows of an id each count, as anchors too, and are each other's positives if their labels agree.
Ties go to the smaller id. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.common import staged
from earshot.llm.vectors import (
    LEAST,
    MOST,
    is_finite,
    largest,
    matrix,
    numbered,
    send_to_blocks,
)

SCALE = 256
# Vectors of a block, side of a tile, and the side from which on products are direct.
BLOCK, TILE, LEAF = 4096, 256, 32


def strassen(a: np.ndarray, b: np.ndarray, leaf: int | None = None) -> np.ndarray:
    """The product of two matrices of integers."""
    leaf = leaf or LEAF
    (m, d), n = a.shape, b.shape[1]
    if min(m, d, n) <= leaf:
        return a @ b
    a = np.pad(a, ((0, m % 2), (0, d % 2))) if m % 2 or d % 2 else a
    b = np.pad(b, ((0, d % 2), (0, n % 2))) if d % 2 or n % 2 else b
    h, k, w = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:h, :k], a[:h, k:], a[h:, :k], a[h:, k:]
    b11, b12, b21, b22 = b[:k, :w], b[:k, w:], b[k:, :w], b[k:, w:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * h, 2 * w), a.dtype)
    out[:h, :w], out[:h, w:] = p1 + p4 - p5 + p7, p3 + p5
    out[h:, :w], out[h:, w:] = p2 + p4, p1 - p2 + p3 + p6
    return out[:m, :n]


def scores(anchors: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Inner products of all rows of both, tile by tile; beyond a long the nearest long."""
    out = np.empty((len(anchors), len(block)), np.int64)
    if largest(anchors) * largest(block) * max(anchors.shape[1], 1) >= 2**62:
        exact = anchors.astype(object) @ block.astype(object).T
        out[:] = np.clip(exact, LEAST, MOST).astype(np.int64)
        return out
    for i in range(0, len(anchors), TILE):
        for j in range(0, len(block), TILE):
            a, b = anchors[i : i + TILE], block[j : j + TILE]
            out[i : i + TILE, j : j + TILE] = strassen(a, b.T)
    return out


def heap(values: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` places of ``among`` with the largest values, earlier places first in ties."""
    held = values[among]
    if len(among) > k:
        least = np.partition(held, len(held) - k)[len(held) - k]
        among, held = among[held >= least], held[held >= least]
    # The complement turns the order round without leaving int64.
    return among[np.argsort(~held, kind="stable")[:k]]


class _Block:
    """A block's vectors by id, and its labels."""

    def __init__(self, table: pa.Table) -> None:
        ids, rows = (table.column(c).to_numpy() for c in ("order", "row"))
        order = np.lexsort((rows, ids))
        self.ids, self.rows = ids[order], rows[order]
        self.labels = table.column("label").to_numpy()[order]
        self.vectors = matrix(table.column("embedding"), SCALE)[order]


def _found(columns: list[list], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _positives(kept: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """anchor, anchor_id, positive_rank, positive_id, positive_score."""
    names = ["anchor", "anchor_id", "vec", "vec_id", "score"]

    def meet(table: pa.Table, asking: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        block = _Block(table)
        for queries in asking:
            vectors = matrix(queries.column("embedding"), SCALE)
            labels, rows, ids = (
                queries.column(c).to_numpy() for c in ("label", "row", "order")
            )
            out: list[list] = [[] for _ in names]
            for label in np.unique(labels).tolist():
                same, mine = np.flatnonzero(block.labels == label), np.flatnonzero(labels == label)
                found = scores(vectors[mine], block.vectors[same])
                for n, values in zip(mine.tolist(), found):
                    best = heap(values, np.flatnonzero(block.rows[same] != rows[n]), k)
                    at = same[best]
                    out[0] += [int(rows[n])] * len(at)
                    out[1] += [int(ids[n])] * len(at)
                    out[2] += block.rows[at].tolist()
                    out[3] += block.ids[at].tolist()
                    out[4] += values[best].tolist()
            yield _found(out, names)

    met = send_to_blocks(kept, anchors, BLOCK, meet, ", ".join(f"{c} long" for c in names))
    order = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "vec_id", "vec")
    return (
        met.withColumn("positive_rank", F.row_number().over(order))
        .where(F.col("positive_rank") <= k)
        .select(
            "anchor", "anchor_id", "positive_rank",
            F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
        )
    )


def _windows(kept: DataFrame, anchors: DataFrame, k: int, low: int, high: int) -> DataFrame:
    """anchor, positive_score, rank, negative_id, negative_score. ``anchors`` have ``opened``,
    their different positive scores."""
    names = ["anchor", "positive_score", "vec", "vec_id", "score"]

    def meet(table: pa.Table, asking: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        block = _Block(table)
        for queries in asking:
            found = scores(matrix(queries.column("embedding"), SCALE), block.vectors)
            labels, rows = (queries.column(c).to_numpy() for c in ("label", "row"))
            out: list[list] = [[] for _ in names]
            for n, opened in enumerate(queries.column("opened").to_pylist()):
                values, others = found[n], block.labels != labels[n]
                for p in opened:
                    # low * p <= 100 * score <= high * p, in whole numbers.
                    least, most = -(-low * p // 100), high * p // 100
                    inside = others & (values >= max(least, LEAST)) & (values <= min(most, MOST))
                    at = heap(values, np.flatnonzero(inside), k)
                    out[0] += [int(rows[n])] * len(at)
                    out[1] += [p] * len(at)
                    out[2] += block.rows[at].tolist()
                    out[3] += block.ids[at].tolist()
                    out[4] += values[at].tolist()
            yield _found(out, names)

    met = send_to_blocks(kept, anchors, BLOCK, meet, ", ".join(f"{c} long" for c in names))
    window = Window.partitionBy("anchor", "positive_score")
    order = window.orderBy(F.col("score").desc(), "vec_id", "vec")
    return (
        met.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select(
            "anchor", "positive_score", "rank",
            F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"),
        )
    )


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of vec_id, label,
    embedding: for every anchor (a condition on vec_id) and each of its best positives, the best
    negatives scoring ``low`` to ``high`` per cent of the positive."""
    usable = vectors.select(
        "vec_id", F.col("label").cast("long").alias("label"), "embedding"
    ).where(F.col("label").isNotNull() & is_finite())
    kept = staged(
        numbered(usable).select(
            "row", "label", "embedding", F.size("embedding").alias("size"),
            F.coalesce(F.col("vec_id").cast("long"), F.lit(MOST)).alias("order"),
            F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
        ),
        "vectors-to-mine",
    )
    anchors = kept.where("is_anchor").drop("is_anchor")
    kept = kept.drop("is_anchor")
    found = staged(_positives(kept, anchors, positives), "positives")
    opened = found.groupBy(F.col("anchor").alias("row")).agg(
        F.sort_array(F.collect_set("positive_score")).alias("opened")
    )
    asking = anchors.join(opened, "row")
    mined = _windows(
        kept.withColumn("opened", F.lit(None).cast("array<long>")), asking, negatives, low, high
    )
    return found.join(mined, ["anchor", "positive_score"]).select(
        "anchor_id",
        F.nullif("positive_id", F.lit(MOST)).alias("positive_id"),
        "rank",
        F.nullif("negative_id", F.lit(MOST)).alias("negative_id"),
        "positive_score",
        "negative_score",
    )
