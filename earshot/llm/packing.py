"""Packing documents into windows of token ids by the sum-of-squares rule.

Documents come one by one. What fills whole windows is cut off first; the rest, shorter than a
window, goes where the sum of the squared numbers of partly filled windows, over their fill
levels, grows least: into a new window or into one of a level it fits, full levels not counted.
An array has the number of open windows of each level.

Each task packs the documents of its part of the table as it reads them, in one streaming pass
that keeps its open windows alone. The pieces of those still open at its end go through the same
rule again, with those of ``MERGED_PARTS`` neighbouring parts: a second pass over them alone. What
that leaves open, or any task beyond ``MOST_OPEN`` windows (documents that never fit together), is
laid in a row and cut into full windows; at the very end, what is left over is cut at powers of two,
which need no padding. So nothing is padded, and only those last pieces and documents longer than a
window are cut.

Null texts are empty and have the end id only; a very long text is cut into as many windows as it
fills; a null doc_id is kept; repeated rows are packed as often as they occur; other columns are not
read. An empty table gives no pieces.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.common import staged
from earshot.llm.tokens import encoder

WINDOW = 1024

# Windows a task keeps open at most, so that its memory is bounded.
MOST_OPEN = 8192

# Parts packed apart; their numbers of sequences are all that is broadcast.
MOST_PARTS = 10_000

# Parts whose open windows are packed together.
MERGED_PARTS = 8

# A piece: doc_id, its document's ids before it, its ids, its document's number of ids.
Piece = tuple[int | None, int, np.ndarray, int]


class SumOfSquares:
    """Windows open so far. ``add`` and ``close`` return the windows they have completed."""

    def __init__(self, window: int = WINDOW) -> None:
        self._window = window
        self._count = np.zeros(window + 1, np.int64)
        self._open: list[list[list[Piece]]] = [[] for _ in range(window + 1)]

    def add(self, piece: Piece) -> list[list[Piece]]:
        size, window, count = len(piece[2]), self._window, self._count
        if size == window:
            return [[piece]]
        # Fill level h > 0 to h + size: the squares change by 1 - 2 N(h), and by 1 + 2 N(h + size)
        # unless that is full. A new window: by 1 + 2 N(size).
        change = 1 - 2 * count[1 : window - size + 1]
        change[:-1] += 1 + 2 * count[size + 1 : window]
        change[count[1 : window - size + 1] == 0] = np.iinfo(np.int64).max
        # Ties go to the fullest window.
        level = len(change) - int(np.argmin(change[::-1]))
        if change[level - 1] >= 1 + 2 * count[size]:
            level = 0
        held = self._open[level].pop() if level else []
        held.append(piece)
        count[level] -= level > 0
        if level + size == window:
            return [held]
        self._hold(level + size, held)
        return list(self.close(last=False)) if count.sum() > MOST_OPEN else []

    def _hold(self, level: int, held: list[Piece]) -> None:
        self._count[level] += 1
        self._open[level].append(held)

    def still_open(self) -> Iterator[list[Piece]]:
        """The windows partly filled, fullest first."""
        for level in reversed(self._open):
            yield from level

    def close(self, last: bool = True) -> Iterator[list[Piece]]:
        """Fill the open windows from one another. Unless it is the last time, the window that
        stays partly filled stays open."""
        row = deque(p for level in reversed(self._open) for held in level for p in held)
        left, window = sum(len(p[2]) for p in row), self._window
        self._count[:] = 0
        for level in self._open:
            level.clear()
        while left:
            if left < window and not last:
                self._hold(left, list(row))
                return
            size = window if left >= window else 1 << (left.bit_length() - 1)
            left, held = left - size, []
            while size:
                doc, start, ids, total = row.popleft()
                held.append((doc, start, ids[:size], total))
                if len(ids) > size:
                    row.appendleft((doc, start + size, ids[size:], total))
                size -= min(size, len(ids))
            yield held


def pieces(docs: DataFrame, path: str, end_id: int, window: int = WINDOW) -> DataFrame:
    """doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id,
    offset: one row per piece."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    id_type = pa.int64() if kind == "bigint" else pa.string()
    schema = pa.schema(
        [
            ("doc_id", id_type), ("start", pa.int64()), ("length", pa.int64()),
            ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("_part", pa.int32()),
            ("_number", pa.int64()), ("offset", pa.int64()), ("_open", pa.bool_()),
        ]
    )
    columns = (
        f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, "
        "_part int, _number long, offset long, _open boolean"
    )

    class Rows:
        """The pieces of numbered windows, as they are handed on."""

        def __init__(self) -> None:
            self.rows: list[tuple] = []
            self.number = 0

        def lay(self, held: list[Piece], part: int, is_open: bool = False) -> None:
            offset = 0
            for doc, start, ids, total in held:
                data = ids.astype("<u4").tobytes()
                self.rows.append(
                    (doc, start, len(ids), data, total, part, self.number, offset, is_open)
                )
                offset += len(ids)
            self.number += 1

        def flush(self) -> pa.RecordBatch:
            values = [pa.array(v, f.type) for v, f in zip(zip(*self.rows, strict=True), schema)]
            self.rows.clear()
            return pa.RecordBatch.from_arrays(values, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, part, out = SumOfSquares(window), 0, Rows()
        enc, end = encoder(path), np.array([end_id], np.uint32)
        for batch in batches:
            docs_ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            part = batch.column("_part")[0].as_py() if len(texts) else part
            for doc, ids in zip(docs_ids, enc.each(texts), strict=True):
                ids = np.append(ids, end)
                for start in range(0, len(ids), window):
                    for held in packer.add((doc, start, ids[start : start + window], len(ids))):
                        out.lay(held, part)
                if len(out.rows) >= 2048:
                    yield out.flush()
        for held in packer.still_open():
            out.lay(held, part, True)
        if out.rows:
            yield out.flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, out, group = SumOfSquares(window), Rows(), None

        def close() -> None:
            for full in packer.close():
                out.lay(full, group)
            out.number = 0

        for batch in batches:
            for doc, start, ids, total, of in zip(
                *(batch.column(c).to_pylist() for c in
                  ("doc_id", "start", "ids", "doc_tokens", "_group")),
                strict=True,
            ):
                if of != group and group is not None:
                    close()
                group = of
                for full in packer.add((doc, start, np.frombuffer(ids, "<u4"), total)):
                    out.lay(full, group)
            if len(out.rows) >= 2048:
                yield out.flush()
        if group is not None:
            close()
        if out.rows:
            yield out.flush()

    parts = docs.select("doc_id", "text").coalesce(MOST_PARTS)
    first = staged(
        parts.withColumn("_part", F.spark_partition_id()).mapInArrow(run, columns), "packing"
    )
    group = (MOST_PARTS + F.floor(F.col("_part") / MERGED_PARTS)).cast("int")
    still = first.where("_open").withColumn("_group", group).repartition("_group")
    merged = staged(
        still.sortWithinPartitions("_group", "_part", "_number", "offset").mapInArrow(
            merge, columns
        ),
        "packing-open",
    )
    # The windows a part had open were numbered after its full ones.
    packed = first.where("NOT _open").unionByName(merged).drop("_open")
    counts = packed.groupBy("_part").agg(F.max("_number").alias("_last"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "_part", F.coalesce(F.sum(F.col("_last") + 1).over(before), F.lit(0)).alias("_from")
    )
    return packed.join(F.broadcast(starts), "_part").select(
        "doc_id", "start", "length", "ids", "doc_tokens",
        (F.col("_from") + F.col("_number")).alias("sequence_id"), "offset",
    )
