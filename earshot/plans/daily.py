"""The daily job: read, clean, join, audit, store, and refresh the views."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot import schemas
from earshot.functions.columns import WEEK_REFERENCE
from earshot.operators.lookup import key_counts
from earshot.operators.profiling import Counted
from earshot.plans import dims, enrich, facts, kpi, partials, views
from earshot.session import (
    configure,
    fresh_folder,
    remove_folder,
    size_shuffles,
    stage,
    together,
)
from earshot.sinks.files import write_audit, write_csv, write_jsonl
from earshot.sinks.tables import write_fact, write_table
from earshot.sources.files import hour_records, text_records
from earshot.sources.records import stage_records

# Fixed value: the landing day read unless another is asked for.
LANDING_DAY = dt.date(2025, 6, 20)

# A load of more listening dates than this is rebalanced before it is written, unless told.
FEW_DATES = 8


@dataclass(frozen=True)
class Locations:
    """Where the job reads and writes. Files and folders, on any store Spark can reach."""

    songs: str
    users: str
    landing: str
    audits: str
    tables: str | None = None
    exports: str | None = None
    # What tells the landing day's files: folder, log or manifest (``hour_records``).
    listed_by: str = "folder"


@dataclass(frozen=True)
class Report:
    """What one run read, kept and found unmatched."""

    songs: int
    users: int
    streams: int
    # Distinct events that no other load day had stored before.
    clean_streams: int
    # Per table and column, before filling.
    missing_values: dict[str, dict[str, int]]
    # Clean events without a known user or song.
    missing_users: int
    missing_songs: int
    # Plays stored over all days, summed over days and genres and over genres.
    daily_total: int
    overall_total: int
    views: tuple[str, ...]


def run(
    spark: SparkSession,
    places: Locations,
    day: dt.date | str = LANDING_DAY,
    reference: dt.date | str = WEEK_REFERENCE,
    tables: views.Tables = views.Tables(),
    rebalance: bool | None = None,
    keep_partials: bool = False,
) -> Report:
    """Read one landing day and the current songs and users, and bring the tables up to date.

    A second run of the same day replaces what the first one wrote. Columns the files have beyond
    the schemas are kept. Each file's text is read and parsed once.
    """
    configure(spark)
    folder = fresh_folder(spark, f"daily-{day}")
    texts = {
        "songs": (text_records(spark, places.songs), schemas.SONGS),
        "users": (text_records(spark, places.users), schemas.USERS),
        "streams": (
            hour_records(spark, places.landing, day, places.listed_by), schemas.STREAMS
        ),
    }

    def receive(name: str) -> Received:
        return Received(*stage_records(*texts[name], f"{folder}/received_{name}"))

    found = together(spark, *[partial(receive, name) for name in texts])
    received = dict(zip(texts, found, strict=True))
    return _load(
        spark, received, places, day, reference, tables, rebalance, keep_partials, folder
    )


@dataclass(frozen=True)
class Received:
    """A table as it came, typed and staged, with its rows and missing values per column."""

    df: DataFrame
    rows: int
    missing: dict[str, int]


def load(
    spark: SparkSession,
    songs: DataFrame,
    users: DataFrame,
    streams: DataFrame,
    places: Locations,
    day: dt.date | str,
    reference: dt.date | str = WEEK_REFERENCE,
    tables: views.Tables = views.Tables(),
    rebalance: bool | None = None,
    keep_partials: bool = False,
) -> Report:
    """The same from typed frames, which are staged first and counted as they are written.

    The clean frames are staged as Parquet in a folder of this run's own, in the one the cluster
    shares; it is removed when all is written, and left for inspection if the job fails. An event
    that another load day has stored is left out, so a play counts once however often it lands.
    Rows per key are counted once, for the joins and the audits. Of the clean lookups, the rows
    whose keys the events have are staged and measured; the size of these, not of the whole
    lookup, chooses how they are joined. Without ``rebalance``
    the number of listening dates decides. ``keep_partials`` stores the day's mergeable partials
    too, and views over them.
    """
    configure(spark)
    folder = fresh_folder(spark, f"daily-{day}")
    frames = {"songs": songs, "users": users, "streams": streams}

    def receive(name: str) -> Received:
        counted = Counted(frames[name])
        staged = stage(counted.df, f"{folder}/received_{name}")
        return Received(staged, counted.rows, counted.missing)

    found = together(spark, *[partial(receive, name) for name in frames])
    received = dict(zip(frames, found, strict=True))
    return _load(
        spark, received, places, day, reference, tables, rebalance, keep_partials, folder
    )


def _load(
    spark: SparkSession,
    received: dict[str, Received],
    places: Locations,
    day: dt.date | str,
    reference: dt.date | str,
    tables: views.Tables,
    rebalance: bool | None,
    keep_partials: bool,
    folder: str,
) -> Report:
    day = dt.date.fromisoformat(str(day))
    songs, users, streams = (received[name].df for name in ("songs", "users", "streams"))

    def staged(name: str, df: DataFrame) -> DataFrame:
        return stage(df, f"{folder}/{name}")

    def location(table: str) -> str | None:
        return f"{places.tables}/{table}" if places.tables else None

    size_shuffles(spark, max(x.rows for x in received.values()))
    users = enrich.told_apart(users, "user_", schemas.USER_KEY, songs)
    streams = enrich.told_apart(streams, "event_", schemas.STREAM_KEY, users, songs)
    clean_users, clean_songs, clean = together(
        spark,
        lambda: staged("users", enrich.clean_users(users)),
        lambda: staged("songs", enrich.clean_songs(songs)),
        lambda: staged("clean", enrich.clean_streams(streams)),
    )
    dates = clean.select(F.to_date("listen_time").alias("listen_date")).distinct()
    of_dates = dates.count()
    many = of_dates > FEW_DATES
    few = [] if many else [r["listen_date"] for r in dates.collect()]
    if rebalance is None:
        rebalance = many
    if spark.catalog.tableExists(tables.fact):
        others = spark.table(tables.fact).where(F.col("load_date") != F.lit(day))
        known = enrich.same_dates(others, dates if many else few)
        if not known.isEmpty():
            clean = staged("streams", enrich.not_yet_stored(clean, known))
    sizes = enrich.Sizes()

    def count(key: str, lookup: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows per key, and the lookup's rows that they meet, staged and measured."""
        counted = staged(f"rows_{key}", key_counts(clean, key))
        met = staged(f"met_{key}", enrich.met(lookup, key, counted))
        sizes.small(met)
        return counted, met

    (by_user, met_users), (by_track, met_songs) = together(
        spark,
        lambda: count("user_id", clean_users),
        lambda: count("track_id", clean_songs),
    )
    counts = {"user_id": by_user, "track_id": by_track}
    enriched = enrich.enrich_streams(clean, met_users, met_songs, "inner", sizes, counts)

    def store() -> None:
        fact, rows = facts.fact_streams(enriched), received["streams"].rows
        spread = of_dates if many and rebalance else 1
        write_fact(fact, tables.fact, day, location("fact_streams"), rebalance, rows, spread)

    def audit() -> dict[str, int]:
        audited = enrich.audit_counts(clean, met_users, met_songs, counts).collect()
        unmatched = dict(map(tuple, audited))
        for name, found in (
            ("missing_users", enrich.missing_users(clean, met_users, sizes, counts)),
            ("missing_songs", enrich.missing_songs(clean, met_songs, sizes, counts)),
        ):
            write_audit(found, f"{places.audits}/{day}/{name}", unmatched[name])
        return unmatched

    unmatched, *_ = together(
        spark,
        audit,
        store,
        lambda: write_table(
            dims.dim_users(clean_users, reference), tables.users, location("dim_users")
        ),
        lambda: write_table(dims.dim_songs(clean_songs), tables.songs, location("dim_songs")),
    )

    def export() -> None:
        stored = spark.table(tables.fact).where(F.col("load_date") == F.lit(day))
        full = stored.select(*[F.col(f"`{c}`") for c in enriched.columns])
        write_csv(full, f"{places.exports}/{day}/streams_full_cleaned")
        write_jsonl(clean_users, f"{places.exports}/{day}/users")
        write_jsonl(clean_songs, f"{places.exports}/{day}/songs")

    steps = [
        lambda: kpi.reconcile_totals(spark.table(tables.fact)).first(),
        lambda: by_user.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0],
    ]
    if keep_partials:
        steps.append(lambda: partials.store_day(spark, tables, day, places.tables))
    if places.exports:
        steps.append(export)
    totals, clean_rows, *_ = together(spark, *steps)

    report = Report(
        songs=received["songs"].rows,
        users=received["users"].rows,
        streams=received["streams"].rows,
        clean_streams=clean_rows,
        missing_values={name: x.missing for name, x in received.items()},
        missing_users=unmatched["missing_users"],
        missing_songs=unmatched["missing_songs"],
        daily_total=totals["daily_total"],
        overall_total=totals["overall_total"],
        views=tuple(views.create_views(spark, tables, keep_partials)),
    )
    remove_folder(spark, folder)
    return report
