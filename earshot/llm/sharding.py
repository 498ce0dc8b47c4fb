"""Sharding by a keyed permutation of global row numbers.

Rows get numbers 0 to N-1 in the order of their key; a Feistel network over Z_a x Z_b, walked
along its cycle until it is below N, permutes them. Row p of the permutation goes to shard
p mod S, slot p div S: shards differ by one row at most, and both can be computed from the row
number, the seed and N alone. Everything is a column expression or a join; no Python runs on
the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.common import staged

ROUNDS = 6

# Walks longer than this don't happen: fewer than one number in sqrt(N) lies outside, so 64 in
# a row have odds of N^-32. A row that did would fail the job, not be misplaced.
LONGEST_WALK = 64

# Key ranges the rows are numbered in; their counts are the only thing that is broadcast.
MOST_RANGES = 10_000


def _round(value: Column, number: int, seed: int) -> Column:
    """32 pseudo-random bits of one half, as DuckDB can compute them too."""
    text = F.concat(F.lit(f"{seed}:{number}:"), value.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def _network(number: Column, a: int, b: int, seed: int) -> Column:
    """One pass of the network over numbers below ``a * b``."""
    halves = F.struct((number % a).alias("x"), F.call_function("div", number, F.lit(a)).alias("y"))
    for r in range(ROUNDS):
        # A one-element transform names the halves, so that they aren't expanded in each round.
        halves = F.transform(F.array(halves), _mix(r, a, b, seed)).getItem(0)
    return F.transform(F.array(halves), lambda h: h["x"] + h["y"] * a).getItem(0)


def _mix(r: int, a: int, b: int, seed: int):
    def mixed(h: Column) -> Column:
        if r % 2:
            return F.struct(h["x"], ((h["y"] + _round(h["x"], r, seed)) % b).alias("y"))
        return F.struct(((h["x"] + _round(h["y"], r, seed)) % a).alias("x"), h["y"])

    return mixed


def halves_of(rows: int) -> tuple[int, int]:
    """The smallest near-square domain that holds ``rows`` numbers."""
    a = math.isqrt(max(rows, 1) - 1) + 1
    return a, max(1, -(-rows // a))


def permuted(number: Column, rows: int, seed: int = 0) -> Column:
    """The place of row ``number`` among ``rows`` in the shuffled order."""
    a, b = halves_of(rows)
    steps = min(LONGEST_WALK, a * b - rows) + 1
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)),
        F.lit(-1).cast("long"),
        lambda at, step: F.when((step > 1) & (at < rows), at).otherwise(
            _network(F.when(step == 1, number).otherwise(at), a, b, seed)
        ),
    )
    left = F.raise_error(F.lit("a cycle walk did not end")).cast("long")
    return F.transform(F.array(walked), lambda p: F.when(p < rows, p).otherwise(left)).getItem(0)


def numbered(df: DataFrame, order: list[str], ranges: int) -> DataFrame:
    """``df`` with ``row_number`` 0 to N-1 in the order of ``order``, without one task for all.

    Rows are dealt into at most ``MOST_RANGES`` key ranges, sorted there and staged with their
    place; a range's start is the sum of the counts before it. Rows that agree in all of
    ``order`` are interchangeable; a long run of them is cut into ranges by a salt.
    """
    # Whole rows travel in one column, so that no column of theirs meets one of ours.
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20))
    rows = df.select(F.struct("*").alias("row"), salt.alias("salt"))
    keys = [F.col("row")[c] for c in order]
    dealt = rows.repartitionByRange(min(ranges, MOST_RANGES), *keys, "salt")
    placed = staged(
        dealt.sortWithinPartitions(*keys, "salt").select(
            "row",
            F.spark_partition_id().alias("range"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place"),
        ),
        "sharding",
    )
    counts = placed.groupBy("range").agg(F.count("*").alias("count"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start")
    )
    return placed.join(F.broadcast(starts), "range").select(
        "row.*", (F.col("start") + F.col("place")).alias("row_number")
    )


def shard(df: DataFrame, order: list[str], shards: int, seed: int = 0, ranges: int = 64) -> DataFrame:
    """``df`` with row_number, shard and slot. Slots of a shard run from 0 without a gap.

    Nulls in ``order`` come first, as one more value; equal rows get neighbouring row numbers
    and are shuffled like any others. An empty table stays empty. Columns called row_number,
    shard or slot in ``df`` are replaced.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    numbers = numbered(df.drop("row_number", "shard", "slot"), order, ranges)
    rows = numbers.count()
    # Both from one value, so that the walk runs once.
    at = permuted(F.col("row_number"), rows, seed)
    return numbers.withColumn("slot", at).withColumns(
        {
            "shard": (F.col("slot") % shards).cast("int"),
            "slot": F.call_function("div", F.col("slot"), F.lit(shards)).cast("long"),
        }
    )
