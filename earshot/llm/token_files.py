"""Token files: ids ranked by frequency, in a byte-aligned code with separate control bytes.

The corpus's ids are counted and ranked, the most frequent first; a rank is written in one to
four bytes, and its length in two bits of a control byte, four ids to each (a block's last byte
is padded). Ranks under 256 take one byte, so common ids do. Reading looks every control byte up
in a table of 256 rows for the four lengths, sums them to places, and gathers the bytes.

A file is a Parquet part of blocks (its writer commits whole tasks, so a lost executor leaves
nothing half-written): range, block, first document's place in the range, documents, their
lengths, control bytes, data bytes. Ranges are disjoint in doc_id, in ascending order; inside,
documents stand in ascending order. The ranks are a table beside the blocks.

Null texts are empty; a very long one is tokenized a stretch at a time and is a block of its own.
Other columns than doc_id and text are not read. Null doc_ids come first. Repeated rows are written as often as they occur,
in the order of their ids' digest where doc_ids tie. An empty table gives empty files.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from earshot.llm.common import staged
from earshot.llm.tokens import tokenized, wide
from earshot.session import fresh_folder

# Ids a block holds at most, but for a longer document, which is a block of its own.
BLOCK_IDS = 1 << 18

# Ranges the documents are dealt into; their counts are all that is broadcast.
MOST_RANGES = 10_000

# Bytes of each of the four ids of a control byte.
_SIZES = ((np.arange(256)[:, None] >> (2 * np.arange(4))[None, :]) & 3) + 1


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of ranks below 2**32."""
    values = np.ascontiguousarray(ranks, "<u4")
    extra = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    padded = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    padded[: len(values)] = extra
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    kept = np.arange(4)[None, :] <= extra[:, None]
    return control.tobytes(), values.view(np.uint8).reshape(-1, 4)[kept].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` ranks of a block."""
    sizes = _SIZES[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    starts = np.cumsum(sizes) - sizes
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    values = raw[starts].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(sizes > k)
        values[more] |= raw[starts[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


def frequencies(tokens: DataFrame) -> DataFrame:
    """id, n: how often each id stands in the corpus. A task sends a row for each id it met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.bincount(np.concatenate([wide(x) for x in batch.column("ids").to_pylist()]))
            if len(new) > len(counts):
                counts, new = new, counts
            counts[: len(new)] += new
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met, pa.int64()), pa.array(counts[met], pa.int64())], names=["id", "n"]
        )

    return tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(
        F.sum("n").alias("n")
    )


@dataclass(frozen=True)
class TokenFiles:
    """Where the blocks are, and the id of each rank (as many as the vocabulary's ids in use)."""

    folder: str
    ids: np.ndarray


_BLOCKS = (
    "range int, block int, start long, doc_ids array<{id}>, sizes array<long>, "
    "control binary, data binary"
)


def write(docs: DataFrame, path: str, end_id: int, folder: str, ranges: int) -> TokenFiles:
    """Tokenize ``docs`` and write their blocks under ``folder``."""
    spark = docs.sparkSession
    tokens = staged(tokenized(docs, path, end_id), "tokens")
    # At most a row for each id of the vocabulary.
    counted = frequencies(tokens).collect()
    ids = np.array([r["id"] for r in sorted(counted, key=lambda r: (-r["n"], r["id"]))], np.uint32)
    ranks = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.uint32)
    ranks[ids] = np.arange(len(ids), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(ranks)
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("range", pa.int32()), ("block", pa.int32()), ("start", pa.int64()),
                ("doc_ids", pa.list_(ids_type)), ("sizes", pa.list_(pa.int64())),
                ("control", pa.binary()), ("data", pa.binary()),
            ]
        )
        block, start, part = 0, 0, 0

        def flush(held: list[tuple]) -> pa.RecordBatch:
            nonlocal block, start
            ranked = shared.value[np.concatenate([x for _, x in held])]
            control, data = pack(ranked)
            row = [part, block, start, [d for d, _ in held], [len(x) for _, x in held]]
            block, start = block + 1, start + len(ranked)
            values = [pa.array([v], f.type) for v, f in zip([*row, control, data], schema)]
            return pa.RecordBatch.from_arrays(values, schema=schema)

        held, size = [], 0
        for batch in batches:
            for d, data, part in zip(
                batch.column("doc_id").to_pylist(),
                batch.column("ids").to_pylist(),
                batch.column("_range").to_pylist(),
                strict=True,
            ):
                x = wide(data)
                if held and size + len(x) > BLOCK_IDS:
                    yield flush(held)
                    held, size = [], 0
                held.append((d, x))
                size += len(x)
        if held:
            yield flush(held)

    ids_type = pa.int64() if kind.simpleString() == "bigint" else pa.string()
    schema = _BLOCKS.format(id="bigint" if ids_type == pa.int64() else "string")
    dealt = tokens.withColumn("_crc", F.crc32("ids")).repartitionByRange(
        min(ranges, MOST_RANGES), "doc_id", "_crc"
    )
    dealt = dealt.sortWithinPartitions("doc_id", "_crc")
    dealt = dealt.withColumn("_range", F.spark_partition_id()).drop("_crc", "n_tokens")
    blocks = dealt.mapInArrow(run, schema)
    blocks.write.mode("overwrite").option("compression", "none").parquet(folder)
    return TokenFiles(folder, ids)


def read(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned
    32-bit) from the files, one row per document written."""
    blocks = spark.read.parquet(files.folder)
    kind = blocks.schema["doc_ids"].dataType.elementType
    sums = blocks.select(
        "range", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")
    )
    counts = sums.groupBy("range").agg(F.sum("n").alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("range"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    shared = spark.sparkContext.broadcast(files.ids)
    id_type = pa.int64() if kind.simpleString() == "bigint" else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.array(row["sizes"], np.int64)
                ids = shared.value[unpack(row["control"], row["data"], int(sizes.sum()))]
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], id_type),
                        pa.array(row["before"] + row["start"] + ends - sizes, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(
                            [x.astype("<u4").tobytes() for x in np.split(ids, ends[:-1])],
                            pa.binary(),
                        ),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    placed = blocks.join(F.broadcast(starts), "range").select(
        "start", "before", "doc_ids", "sizes", "control", "data"
    )
    return placed.mapInArrow(
        run, f"doc_id {kind.simpleString()}, start long, n_tokens long, ids binary"
    )


def round_trip(docs: DataFrame, path: str, end_id: int, ranges: int) -> DataFrame:
    """Write the files to the shared folder and read them back."""
    folder = fresh_folder(docs.sparkSession, "token-files")
    return read(docs.sparkSession, write(docs, path, end_id, folder, ranges))

