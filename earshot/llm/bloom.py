"""A filter of bounded size for 64-bit hashes: it lets all that were put in pass, and few others."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# 32 MB at most, whatever is put in; past 2**25 hashes it lets more and more others pass.
MOST_BITS = 1 << 28


# Words that are sent together.
_CHUNK = 1 << 13


def build(hashes: DataFrame, column: str, rows: int) -> np.ndarray:
    """The words of a filter over ``rows`` evenly spread longs. Bits are joined per word before
    they are shuffled, and words are laid into chunks, so the driver gets the filter's own size
    at most."""
    bits = 1 << 19
    while bits < MOST_BITS and bits < 10 * rows:
        bits *= 2
    places = F.array(
        F.col(column).bitwiseAND(F.lit(bits - 1)),
        F.shiftrightunsigned(column, 32).bitwiseAND(F.lit(bits - 1)),
    )
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_p").bitwiseAND(63).cast("int"))
    joined = (
        hashes.select(F.explode(places).alias("_p"))
        .select(F.shiftright("_p", 6).alias("word"), bit.alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
    )

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: dict[int, np.ndarray] = {}
        for batch in batches:
            word, found = batch.column("word").to_numpy(), batch.column("bits").to_numpy()
            for chunk in np.unique(word // _CHUNK).tolist():
                mine = word // _CHUNK == chunk
                held = chunks.setdefault(chunk, np.zeros(_CHUNK, np.int64))
                held[word[mine] % _CHUNK] = found[mine]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(chunks), pa.int64()),
                pa.array([x.tobytes() for x in chunks.values()], pa.binary()),
            ],
            names=["chunk", "words"],
        )

    chunked = joined.repartition(16, F.shiftright("word", 13)).mapInArrow(
        lay, "chunk long, words binary"
    )
    words = np.zeros(bits // 64, np.int64)
    for row in chunked.collect():
        words[row["chunk"] * _CHUNK : (row["chunk"] + 1) * _CHUNK] = np.frombuffer(
            row["words"], np.int64
        )
    return words.view(np.uint64)


def passes(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which unsigned 64-bit hashes the filter lets pass."""
    last = np.uint64(len(words) * 64 - 1)

    def is_set(places: np.ndarray) -> np.ndarray:
        return (words[places >> np.uint64(6)] >> (places & np.uint64(63))) & np.uint64(1) > 0

    return is_set(hashes & last) & is_set((hashes >> np.uint64(32)) & last)
