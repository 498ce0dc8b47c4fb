"""Clean frames, joined events and audits of unmatched events."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot import schemas
from earshot.operators.cleaning import fill_and_keep_first, parse_timestamps
from earshot.operators.lookup import ROWS_PER_SLICE, is_small, key_counts, lookup_join


class Sizes:
    """Which lookups are small enough to broadcast. A frame is measured (``is_small``) when it is
    first asked about, and the answer holds for that very frame only."""

    def __init__(self) -> None:
        self._measured: list[tuple[DataFrame, bool]] = []

    def small(self, lookup: DataFrame) -> bool:
        for known, small in self._measured:
            if known is lookup:
                return small
        self._measured.append((lookup, is_small(lookup)))
        return self._measured[-1][1]


# Rows per user_id and per track_id, where they are known already.
Counts = Mapping[str, DataFrame]


def union_streams(parts: Sequence[DataFrame]) -> DataFrame:
    """Stack event frames with the same columns."""
    return reduce(DataFrame.unionByName, parts)


def clean_streams(streams: DataFrame) -> DataFrame:
    """Typed, filled, one row per user, track and listening time. Further columns stay; of rows
    that differ in them alone the least is kept."""
    typed = parse_timestamps(streams, ["listen_time"])
    return fill_and_keep_first(typed, schemas.STREAM_KEY)


def clean_users(users: DataFrame) -> DataFrame:
    """Typed, filled, one row per user."""
    typed = parse_timestamps(users, ["created_at"])
    return fill_and_keep_first(typed, schemas.USER_KEY, schemas.USER_ORDER)


def clean_songs(songs: DataFrame) -> DataFrame:
    """Filled, one row per track."""
    return fill_and_keep_first(songs, schemas.SONG_KEY, schemas.SONG_ORDER)


def told_apart(df: DataFrame, prefix: str, keys: Sequence[str], *others: DataFrame) -> DataFrame:
    """``df`` with ``prefix`` before the columns that ``others`` have too, but for the keys."""
    taken = {c for other in others for c in other.columns} - set(keys)
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns if c in taken})


def same_dates(stored: DataFrame, dates: Sequence[dt.date] | DataFrame) -> DataFrame:
    """The keys of the events of ``stored``, a fact of other load days, on some listening dates:
    a few named ones, which prune its partitions before anything runs, or a frame of them."""
    if isinstance(dates, DataFrame):
        near = stored.join(dates, "listen_date", "left_semi")
    else:
        near = stored.where(F.col("listen_date").isin(*dates)) if dates else stored.limit(0)
    return near.select(*schemas.STREAM_KEY)


def not_yet_stored(streams: DataFrame, known: DataFrame) -> DataFrame:
    """The events whose key ``known`` (``same_dates``) doesn't have. A fact bucketed by the key is
    joined bucket by bucket: the events move, the stored ones don't."""
    return streams.join(known, schemas.STREAM_KEY, "left_anti")


def met(lookup: DataFrame, key: str, counted: DataFrame) -> DataFrame:
    """The rows of ``lookup`` whose key some event has (``counted``: rows per key). No other can
    join an event, so inner joins and audits give the same with these alone."""
    return lookup.join(counted.select(key), key, "left_semi")


def enrich_streams(
    streams: DataFrame,
    users: DataFrame,
    songs: DataFrame,
    how: str = "inner",
    sizes: Sizes | None = None,
    counts: Counts | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Events with their user's and song's columns. ``how='left'`` keeps unmatched events.
    Without ``sizes`` nothing is broadcast."""
    counts = counts or {k: key_counts(streams, k) for k in ("user_id", "track_id")}
    joined = streams
    for key, lookup in (("user_id", users), ("track_id", songs)):
        small = sizes is not None and sizes.small(lookup)
        joined = lookup_join(joined, lookup, key, how, small, counts[key], rows_per_slice)
    return joined


def _missing(
    streams: DataFrame,
    lookup: DataFrame,
    key: str,
    sizes: Sizes | None,
    counts: Counts | None,
    rows_per_slice: int,
) -> DataFrame:
    small = sizes is not None and sizes.small(lookup)
    known = lookup.select(key)
    counted = counts[key] if counts else None
    return lookup_join(streams, known, key, "left_anti", small, counted, rows_per_slice)


def missing_users(
    streams: DataFrame,
    users: DataFrame,
    sizes: Sizes | None = None,
    counts: Counts | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Events whose user is unknown."""
    return _missing(streams, users, "user_id", sizes, counts, rows_per_slice)


def missing_songs(
    streams: DataFrame,
    songs: DataFrame,
    sizes: Sizes | None = None,
    counts: Counts | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Events whose song is unknown."""
    return _missing(streams, songs, "track_id", sizes, counts, rows_per_slice)


def audit_counts(
    streams: DataFrame, users: DataFrame, songs: DataFrame, counts: Counts | None = None
) -> DataFrame:
    """One row per audit: audit, events. Counts per key come first, so the joins see one row
    per distinct key, however the events are spread."""
    counts = counts or {k: key_counts(streams, k) for k in ("user_id", "track_id")}

    def unmatched(name: str, lookup: DataFrame, key: str) -> DataFrame:
        missing = counts[key].join(lookup.select(key), key, "left_anti")
        total = F.coalesce(F.sum("_rows"), F.lit(0).cast("long"))
        return missing.agg(total.alias("events")).select(F.lit(name).alias("audit"), "events")

    return unmatched("missing_users", users, "user_id").unionByName(
        unmatched("missing_songs", songs, "track_id")
    )
