"""Exact top-k search by inner product, with Fagin's threshold algorithm.

Vectors stay in blocks, sorted along every dimension once; the queries are sent to every block and
stream past it. For a query, the lists are read from the end that its component favours, all to the
same depth; vectors met for the first time are scored in full; and reading stops when no unread
vector can beat the kth score found, because the bound, the query's product with the components at
the present depth, is below it. The blocks' top k are merged per query. No pair of vectors leaves a
block unless it is among its k best.

Components x become floor(64 x), x as double. Vectors that are null, or hold null or non-finite
components, take no part; nor do rows without an id. Vectors of another length than the query's
aren't candidates. Scores that might pass 2**63 are computed in Python's integers, and one beyond a
long counts as the nearest long. Ties go to the smaller id. Repeated rows of an id each count: as
candidates, for one another too, and as queries, with a result each. Other columns are not read. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.common import staged
from earshot.llm.vectors import LEAST, MOST, is_finite, matrix, numbered, send_to_blocks

SCALE = 64
# Vectors of a block, and queries held at a time.
BLOCK = 16_384
QUERY_BLOCK = 512
# How far the lists are read at a time.
_DEPTH = 256


class Lists:
    """A block's vectors, sorted along each dimension. ``rows`` tell them apart; without, their
    ids do."""

    def __init__(
        self, ids: np.ndarray, vectors: np.ndarray, rows: np.ndarray | None = None
    ) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.rows = (ids if rows is None else rows)[order]
        # Products are exact in floats that hold all their sums, else in integers.
        self._largest = float(np.abs(self.vectors.astype(np.float64)).max(initial=0))
        self._as: dict[type, np.ndarray] = {}
        self.order = np.argsort(self.vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.vectors, self.order, axis=0)

    def score(self, rows: np.ndarray, query: np.ndarray, kind: type) -> np.ndarray:
        if kind not in self._as:
            self._as[kind] = self.vectors.astype(kind)
        found = self._as[kind][rows] @ query.astype(kind)
        return (np.clip(found, LEAST, MOST) if kind is object else found).astype(np.int64)

    def top(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best but the row ``own``, ties to smaller ids."""
        n = len(self.ids)
        most = self._largest * float(np.abs(query.astype(np.float64)).sum())
        exact = ((2**24, np.float32), (2**53, np.float64), (2**62, np.int64))
        kind = next((kind for bound, kind in exact if most < bound), object)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        weights_up, weights_down = query[up], query[down]
        seen = np.zeros(n, bool)
        seen[self.rows == own] = True
        rows, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth = 0
        while True:
            end = min(n, depth + _DEPTH)
            met = np.zeros(n, bool)
            met[self.order[n - end : n - depth, up].ravel()] = True
            met[self.order[depth:end, down].ravel()] = True
            if not len(up) + len(down):
                met[:] = True
            new = np.flatnonzero(met & ~seen)
            seen[new] = True
            rows = np.concatenate([rows, new])
            scores = np.concatenate([scores, self.score(new, query, kind)])
            if len(rows) > k:
                # The kth score and all above it; ties are cut by id, which is the row order.
                least = np.partition(scores, len(scores) - k)[len(scores) - k]
                keep = np.flatnonzero(scores >= least)
                keep = keep[np.lexsort((rows[keep], -scores[keep]))[:k]]
                rows, scores = rows[keep], scores[keep]
            if end == n or seen.all():
                break
            bound = sum(
                int(x) * int(w)
                for at, of, weights in ((n - end, up, weights_up), (end - 1, down, weights_down))
                for x, w in zip(self.sorted[at, of].tolist(), weights.tolist())
            )
            # An unread vector that ties with the kth may have the smaller id.
            if len(rows) >= k and int(scores.min()) > bound:
                break
            depth = end
        order = np.lexsort((rows, -scores))
        return self.ids[rows[order]], scores[order]


def search(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: for every row of vec_id, embedding whose id meets
    ``is_query`` (a condition on vec_id) the ``k`` best of all the others."""
    usable = vectors.select("vec_id", "embedding").where(
        F.col("vec_id").isNotNull() & is_finite()
    )
    kept = staged(
        numbered(usable).select(
            "row", "vec_id", "embedding", F.size("embedding").alias("size"),
            F.coalesce(is_query, F.lit(False)).alias("is_query"),
        ),
        "vectors",
    )
    names = ["query", "query_id", "vec_id", "score"]

    def meet(table: pa.Table, asking: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        ids, rows = (table.column(c).to_numpy() for c in ("vec_id", "row"))
        lists = Lists(ids, matrix(table.column("embedding"), SCALE), rows)
        for queries in asking:
            wanted = matrix(queries.column("embedding"), SCALE)
            out: list[list] = [[] for _ in names]
            for own, own_id, query in zip(
                queries.column("row").to_pylist(), queries.column("vec_id").to_pylist(), wanted
            ):
                found, scores = lists.top(own, query, k)
                out[0] += [own] * len(found)
                out[1] += [own_id] * len(found)
                out[2] += found.tolist()
                out[3] += scores.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)

    queries = kept.where("is_query").drop("is_query")
    best = send_to_blocks(
        kept.drop("is_query"), queries, BLOCK, meet,
        ", ".join(f"{c} long" for c in names), QUERY_BLOCK,
    )
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
