"""Joining events to a lookup table with one row per key, at any size and skew of either side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A lookup measured to be within both bounds is broadcast; any other is shuffled.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20

# What a row of a broadcast table takes beside its text: its header, then every value.
_ROW_BYTES, _VALUE_BYTES = 32, 16

# A key with more event rows than this is cut into slices of about this many rows.
ROWS_PER_SLICE = 1_000_000


def is_small(lookup: DataFrame) -> bool:
    """Whether a lookup is within the broadcast bounds, measured: one aggregate counts its rows
    and sums the length of its text."""
    text = [f.name for f in lookup.schema.fields if isinstance(f.dataType, T.StringType)]
    lengths = [F.coalesce(F.sum(F.octet_length(F.col(f"`{c}`"))), F.lit(0)) for c in text]
    rows, *measured = lookup.agg(F.count("*"), *lengths).first()
    size = sum(measured) + rows * (_ROW_BYTES + _VALUE_BYTES * len(lookup.columns))
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def key_counts(events: DataFrame, key: str) -> DataFrame:
    """Rows per key, the null key too: ``key`` and ``_rows``."""
    return events.groupBy(key).agg(F.count("*").alias("_rows"))


def hot_keys(counts: DataFrame, key: str, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """The keys above ``rows_per_slice`` rows, with the slices each one needs. There are no more
    of them than events / rows_per_slice."""
    return counts.where(F.col("_rows") > rows_per_slice).select(
        key, F.ceil(F.col("_rows") / rows_per_slice).cast("int").alias("_slices")
    )


def lookup_join(
    events: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "inner",
    small: bool = False,
    counts: DataFrame | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Join ``events`` to ``lookup`` on ``key``; ``how`` is inner, left or left_anti. The
    events' columns come first, then the lookup's.

    ``small`` says that the lookup was found to be so by ``is_small``: it is broadcast and the
    events are not shuffled. Otherwise both sides are shuffled on (key, slice): event rows of a
    hot key, or of none, spread over its slices, and that key's lookup rows are repeated once per
    slice, which adds at most one lookup row per ``rows_per_slice`` events. The slice comes from
    the row and the partition it is in, so exact copies spread as well, and a retried task sends
    every row to the same place. The list of hot keys is broadcast if it is measured to be small,
    else it is joined like any table.

    ``counts`` are the rows per key (``key_counts``) of these events or of more, where they are
    known already.
    """
    if how not in ("inner", "left", "left_anti"):
        raise ValueError(f"unsupported join: {how}")
    added = [] if how == "left_anti" else [c for c in lookup.columns if c != key]
    columns = [F.col(f"`{c}`") for c in (*events.columns, *added)]
    if small:
        return events.join(F.broadcast(lookup), key, how).select(columns)

    counts = key_counts(events, key) if counts is None else counts
    hot = hot_keys(counts, key, rows_per_slice).withColumnRenamed(key, "_hot")
    if is_small(hot):
        hot = F.broadcast(hot)
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in events.columns], F.spark_partition_id())
    slices = F.coalesce("_slices", F.lit(1))
    sliced_events = events.join(hot, F.col(key).eqNullSafe(F.col("_hot")), "left").withColumn(
        "_slice", F.pmod(spread, slices).cast("int")
    )
    sliced_lookup = lookup.join(hot, F.col(key) == F.col("_hot"), "left").withColumn(
        "_slice", F.explode(F.sequence(F.lit(0), slices - 1))
    )
    return (
        sliced_events.drop("_slices", "_hot")
        .join(sliced_lookup.drop("_slices", "_hot"), [key, "_slice"], how)
        .select(columns)
    )
