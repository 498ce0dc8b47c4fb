"""The registered queries: each takes a session and a data folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import Inputs, map_events, times_as_text
from earshot import schemas
from earshot.operators import profiling
from earshot.operators.ordinal import with_ordinal
from earshot.plans import daily, dims, enrich, facts, ingest, kpi, partials, views
from earshot.session import configure, exists, fresh_folder, name_own_folder, size_shuffles, stage
from earshot.sinks.files import write_csv, write_jsonl
from earshot.sinks.jdbc import jdbc_column_types
from earshot.sinks.kafka import to_kafka_records
from earshot.sources.files import read_csv_table, read_hour_partitions, read_jsonl
from earshot.sources.records import parse_records
from earshot.streaming.landing import land_batches, land_records

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {}


@lru_cache(maxsize=8)
def _inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(spark, sf_dir)


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """The frames the queries read, on a session set up for them."""
    name_own_folder(spark)
    found = _inputs(configure(spark), sf_dir)
    size_shuffles(spark, found.event_rows)
    return found


def forget() -> None:
    """Measure and store anew from now on."""
    _inputs.cache_clear()
    stored.cache_clear()
    stored_partials.cache_clear()


def _query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    _QUERIES[build.__name__] = build
    return build


def all_queries() -> dict[str, Query]:
    def bound(build: Callable[[Inputs], DataFrame]) -> Query:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(inputs(spark, sf_dir))

        return query

    return {name: bound(build) for name, build in _QUERIES.items()}


# --- cleaning ---------------------------------------------------------------------------


@_query
def clean_streams(i: Inputs) -> DataFrame:
    return times_as_text(i.clean_streams, "listen_time")


@_query
def clean_users(i: Inputs) -> DataFrame:
    return i.clean_users


@_query
def clean_songs(i: Inputs) -> DataFrame:
    return i.clean_songs


@_query
def union_streams(i: Inputs) -> DataFrame:
    return enrich.union_streams([i.streams, i.streams_dirty])


@_query
def null_profile(i: Inputs) -> DataFrame:
    tables = {"streams": i.streams_dirty, "users": i.users_dirty, "songs": i.songs_dirty}
    profiles = [
        profiling.null_profile(df).withColumn("table_name", F.lit(name))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, profiles)


@_query
def duplicate_profile(i: Inputs) -> DataFrame:
    repeated = profiling.duplicate_profile(i.streams_dirty, schemas.STREAM_KEY)
    return times_as_text(repeated, "listen_time")


@_query
def duplicate_profile_songs(i: Inputs) -> DataFrame:
    return profiling.duplicate_profile(i.songs_dirty, schemas.SONG_KEY)


@_query
def profile(i: Inputs) -> DataFrame:
    return profiling.profile(
        {"streams": i.streams_dirty, "users": i.users_dirty, "songs": i.songs_dirty}
    )


@_query
def preview(i: Inputs) -> DataFrame:
    return profiling.preview(i.songs, 10, ["id"])


# --- joins and audits -------------------------------------------------------------------


@_query
def enrich_streams(i: Inputs) -> DataFrame:
    return times_as_text(i.enriched_dirty, "listen_time")


@_query
def enrich_streams_left(i: Inputs) -> DataFrame:
    joined = enrich.enrich_streams(
        i.clean_streams, i.clean_users, i.clean_songs, "left", i.sizes
    )
    return times_as_text(joined, "listen_time")


# Small enough that the given tables have keys above it.
_ROWS_PER_SLICE = 20


@_query
def enrich_streams_sliced(i: Inputs) -> DataFrame:
    """The join for lookups too large to broadcast, with its hot keys cut into slices."""
    joined = enrich.enrich_streams(
        i.clean_streams, i.clean_users, i.clean_songs, rows_per_slice=_ROWS_PER_SLICE
    )
    return times_as_text(joined, "listen_time")


@_query
def audit_missing_users(i: Inputs) -> DataFrame:
    found = enrich.missing_users(i.clean_streams, i.clean_users, i.sizes)
    return times_as_text(found, "listen_time")


@_query
def audit_missing_songs(i: Inputs) -> DataFrame:
    found = enrich.missing_songs(i.clean_streams, i.clean_songs, i.sizes)
    return times_as_text(found, "listen_time")


@_query
def audit_missing_users_sliced(i: Inputs) -> DataFrame:
    found = enrich.missing_users(
        i.clean_streams, i.clean_users, rows_per_slice=_ROWS_PER_SLICE
    )
    return times_as_text(found, "listen_time")


@_query
def audit_missing_songs_sliced(i: Inputs) -> DataFrame:
    found = enrich.missing_songs(
        i.clean_streams, i.clean_songs, rows_per_slice=_ROWS_PER_SLICE
    )
    return times_as_text(found, "listen_time")


@_query
def audit_counts(i: Inputs) -> DataFrame:
    return enrich.audit_counts(i.clean_streams, i.clean_users, i.clean_songs)


# --- tables -----------------------------------------------------------------------------


@_query
def fact_streams(i: Inputs) -> DataFrame:
    return facts.fact_streams(i.enriched)


@_query
def fact_streams_dirty(i: Inputs) -> DataFrame:
    return times_as_text(facts.fact_streams(i.enriched_dirty), "listen_time")


@_query
def fact_streams_slim(i: Inputs) -> DataFrame:
    return facts.fact_streams_slim(facts.fact_streams(i.enriched))


@_query
def dim_users(i: Inputs) -> DataFrame:
    return dims.dim_users(i.users)


@_query
def dim_users_dirty(i: Inputs) -> DataFrame:
    return dims.dim_users(i.clean_users)


@_query
def dim_songs(i: Inputs) -> DataFrame:
    return dims.dim_songs(i.songs)


@_query
def dim_songs_dirty(i: Inputs) -> DataFrame:
    return dims.dim_songs(i.clean_songs)


# --- KPIs on the clean mapping, and on the cleaned dirty one ----------------------------


# KPIs read a stored fact, as the job's views do.


def _fact(i: Inputs) -> DataFrame:
    return i.fact


def _fact_dirty(i: Inputs) -> DataFrame:
    return i.fact_dirty


@_query
def genre_streams(i: Inputs) -> DataFrame:
    return kpi.genre_streams(_fact(i))


@_query
def genre_explicit(i: Inputs) -> DataFrame:
    return kpi.genre_explicit(dims.dim_songs(i.songs))


@_query
def most_popular_track(i: Inputs) -> DataFrame:
    return kpi.most_popular_track(_fact(i))


@_query
def most_popular_track_daily(i: Inputs) -> DataFrame:
    return kpi.most_popular_track_daily(_fact(i))


@_query
def genre_kpi(i: Inputs) -> DataFrame:
    return kpi.genre_kpi(_fact(i), dims.dim_songs(i.songs))


@_query
def genre_kpi_dirty(i: Inputs) -> DataFrame:
    return kpi.genre_kpi(_fact_dirty(i), dims.dim_songs(i.clean_songs))


@_query
def genre_kpi_raw_songs(i: Inputs) -> DataFrame:
    """The dimension built from uncleaned songs: repeated tracks count, null genres stay."""
    return kpi.genre_kpi(_fact_dirty(i), dims.dim_songs(i.songs_dirty))


@_query
def daily_genre_kpi(i: Inputs) -> DataFrame:
    return kpi.daily_genre_kpi(_fact(i))


@_query
def daily_genre_kpi_dirty(i: Inputs) -> DataFrame:
    return kpi.daily_genre_kpi(_fact_dirty(i))


@_query
def hourly_totals(i: Inputs) -> DataFrame:
    return kpi.hourly_totals(_fact(i))


@_query
def top_genre_hourly(i: Inputs) -> DataFrame:
    return kpi.top_genre_hourly(_fact(i))


@_query
def top_artist_hourly(i: Inputs) -> DataFrame:
    return kpi.top_artist_hourly(_fact(i))


@_query
def top_age_group_hourly(i: Inputs) -> DataFrame:
    return kpi.top_age_group_hourly(_fact(i))


@_query
def hourly_kpi(i: Inputs) -> DataFrame:
    return kpi.hourly_kpi(_fact(i))


@_query
def hourly_kpi_dirty(i: Inputs) -> DataFrame:
    return kpi.hourly_kpi(_fact_dirty(i))


@_query
def track_summary(i: Inputs) -> DataFrame:
    return kpi.track_summary(_fact(i), dims.dim_songs(i.songs))


@_query
def track_summary_dirty(i: Inputs) -> DataFrame:
    return kpi.track_summary(_fact_dirty(i), dims.dim_songs(i.clean_songs))


@_query
def track_summary_raw_songs(i: Inputs) -> DataFrame:
    """The dimension built from uncleaned songs: a repeated track gives a row for each."""
    return kpi.track_summary(_fact_dirty(i), dims.dim_songs(i.songs_dirty))


@_query
def track_popularity(i: Inputs) -> DataFrame:
    return kpi.track_popularity(_fact(i), dims.dim_songs(i.songs))


@_query
def reconcile_totals(i: Inputs) -> DataFrame:
    return kpi.reconcile_totals(_fact(i))


@_query
def reconcile_totals_dirty(i: Inputs) -> DataFrame:
    return kpi.reconcile_totals(_fact_dirty(i))


# --- SQL views --------------------------------------------------------------------------


def _view(i: Inputs, name: str) -> DataFrame:
    return i.spark.sql(views.VIEWS[name], fact=_fact(i), songs=dims.dim_songs(i.songs))


@_query
def view_genre_kpi(i: Inputs) -> DataFrame:
    return _view(i, "view_genre_kpi")


@_query
def view_hourly_kpi(i: Inputs) -> DataFrame:
    return _view(i, "view_hourly_kpi")


@_query
def view_track_summary(i: Inputs) -> DataFrame:
    return _view(i, "view_track_summary")


# --- sources and sinks: written to the shared folder and read back ----------------------


def _text_events(i: Inputs) -> DataFrame:
    """Events as producers send them: the time is text."""
    return times_as_text(i.streams, "listen_time")


@_query
def jsonl_round_trip(i: Inputs) -> DataFrame:
    folder = fresh_folder(i.spark, "jsonl")
    write_jsonl(i.songs_dirty, folder)
    back = read_jsonl(i.spark, folder, schemas.SONGS)
    return back.select(i.songs.columns)


@_query
def csv_round_trip(i: Inputs) -> DataFrame:
    folder = fresh_folder(i.spark, "csv")
    write_csv(i.streams_dirty, folder)
    back = read_csv_table(i.spark, folder, schemas.STREAMS)
    return times_as_text(back, "listen_time")


@_query
def streams_full_cleaned(i: Inputs) -> DataFrame:
    """The joined table as a CSV export, read back as text."""
    folder = fresh_folder(i.spark, "streams_full_cleaned")
    write_csv(i.enriched, folder)
    return i.spark.read.schema(schemas.text_form(i.enriched.schema)).option(
        "header", True
    ).csv(folder)


@_query
def kafka_keys(i: Inputs) -> DataFrame:
    """Published events keyed by their ordinals, in the order of the file."""
    return to_kafka_records(with_ordinal(_text_events(i)), key="ordinal")


@_query
def kafka_records(i: Inputs) -> DataFrame:
    """Published events with a key of their own."""
    return to_kafka_records(times_as_text(i.events, "listen_time"), key="event_id")


@_query
def kafka_events(i: Inputs) -> DataFrame:
    """Published values parsed back, as a consumer of the topic would."""
    records = to_kafka_records(_text_events(i))
    return times_as_text(parse_records(records, schemas.STREAMS), "listen_time")


def _land(i: Inputs, land=land_records) -> str:
    """Stream the events table into hour folders; returns the landing root."""
    folder = fresh_folder(i.spark, "landing")
    stream = i.spark.readStream.schema(i.table("events").schema).parquet(
        f"{i.sf_dir}/event[s].parquet"
    )
    events = times_as_text(map_events(stream).drop("event_id"), "listen_time")
    land(
        events.select("listen_time", F.to_json(F.struct("*")).alias("value")),
        f"{folder}/topic",
        f"{folder}/checkpoint",
        F.to_timestamp("listen_time"),
        files_per_hour=64,
    ).awaitTermination()
    return f"{folder}/topic"


@_query
def land_and_read_day(i: Inputs) -> DataFrame:
    """The events landed by hour, and one day of them read back with its hours."""
    day = read_hour_partitions(
        i.spark, _land(i), "2024-01-15", schemas.STREAMS, keep_hours=True, listed_by="log"
    )
    return times_as_text(day, "listen_time")


@_query
def landed_day_manifest(i: Inputs) -> DataFrame:
    """The same, landed in batches and read through that day's manifest."""
    day = read_hour_partitions(
        i.spark, _land(i, land_batches), "2024-01-15", schemas.STREAMS, True, "manifest"
    )
    return times_as_text(day, "listen_time")


@_query
def landed_hours(i: Inputs) -> DataFrame:
    """Events per landed hour, over all days."""
    landed = read_hour_partitions(
        i.spark, _land(i), None, schemas.STREAMS, keep_hours=True, listed_by="log"
    )
    return landed.groupBy(*schemas.HOUR_PARTITIONS.names).agg(F.count("*").alias("events"))


@_query
def stored_hourly_kpi(i: Inputs) -> DataFrame:
    """Hourly KPI over a fact that was cleaned, joined and stored first."""
    folder = fresh_folder(i.spark, "fact")
    return kpi.hourly_kpi(stage(facts.fact_streams(i.enriched_dirty), folder))


@_query
def jsonl_extra_columns(i: Inputs) -> DataFrame:
    """Events with columns no schema names, written and read back with them."""
    folder = fresh_folder(i.spark, "extra")
    write_jsonl(_text_events(i).withColumns(
        {"device": F.concat(F.lit("d"), F.col("user_id") % 7), "volume": F.col("user_id") % 11}
    ), folder)
    back = read_jsonl(i.spark, folder, schemas.STREAMS, further=True)
    return times_as_text(enrich.clean_streams(back), "listen_time")


@_query
def jsonl_bare_nan(i: Inputs) -> DataFrame:
    """Lines with a bare NaN for a missing value, blank lines between, and NaN within text."""
    folder = fresh_folder(i.spark, "nan")
    named = F.when(F.col("user_id") % 5 == 0, '"NaN, it is"').otherwise(
        F.concat(F.lit('"'), F.col("user_name"), F.lit('"'))
    )
    age = F.when(F.col("user_id") % 9 == 0, "NaN").otherwise(F.col("user_age").cast("string"))
    country = F.when(F.col("user_id") % 7 == 0, "NaN").otherwise('"here"')
    line = F.concat(
        F.lit('{"user_id": '), "user_id", F.lit(', "user_name": '), named,
        F.lit(', "user_age": '), age, F.lit(', "user_country": '), country,
        F.lit(', "created_at": NaN}'),
    )
    blank = F.array(line, F.lit("   "))
    i.users.select(F.explode(blank)).write.text(folder)
    return read_jsonl(i.spark, folder, schemas.USERS).drop("created_at")


@_query
def json_array_round_trip(i: Inputs) -> DataFrame:
    """Songs as files that hold one JSON array each, several lines long, of ids close together, so
    that there are more arrays in a larger table and not longer ones."""
    folder = fresh_folder(i.spark, "array")
    songs = i.songs_dirty.groupBy(F.expr("id div 10000").alias("part")).agg(
        F.to_json(
            F.collect_list(F.struct("*")), {"ignoreNullFields": "false", "pretty": "true"}
        ).alias("value")
    )
    songs.write.partitionBy("part").text(folder)
    lists = read_jsonl(i.spark, folder, schemas.SONGS, multiline=True)
    return lists.select(i.songs.columns)


@_query
def any_missing(i: Inputs) -> DataFrame:
    """Whether a table has any missing value."""
    tables = {
        "streams": i.streams_dirty, "users": i.users_dirty, "songs": i.songs_dirty,
        "clean_streams": i.clean_streams, "clean_users": i.clean_users,
    }
    flags = [
        profiling.null_profile(df).agg((F.max("missing") > 0).alias("missing"))
        .withColumn("table_name", F.lit(name))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, flags)


@_query
def column_types(i: Inputs) -> DataFrame:
    """The database types declared for songs and users as their CSV files are loaded."""
    folder = fresh_folder(i.spark, "types")
    write_csv(_all_song_columns(i), f"{folder}/songs")
    write_csv(times_as_text(i.users, "created_at"), f"{folder}/users")
    frames = ingest.database_frames(i.spark, f"{folder}/songs", f"{folder}/users")

    def typed(table: str, df: DataFrame) -> DataFrame:
        columns = [F.col(f"`{c}`") for c in df.columns]
        counts = df.agg(*[F.count(c).alias(n) for c, n in zip(columns, df.columns, strict=True)])
        kinds = [F.lit(x) for pair in jdbc_column_types(df.schema).items() for x in pair]
        return counts.unpivot([], columns, "column_name", "filled").select(
            F.lit(table).alias("table_name"), "column_name",
            F.element_at(F.create_map(*kinds), F.col("column_name")).alias("type"), "filled",
        )

    return reduce(DataFrame.unionByName, [typed(*x) for x in frames.items()])


def _all_song_columns(i: Inputs) -> DataFrame:
    """All 21 song columns; those the tables don't have are null."""
    have = i.songs.columns
    return i.songs.select(
        *[c if c in have else F.lit(None).cast(schemas.SONGS[c].dataType).alias(c)
          for c in schemas.SONGS.names]
    )


@_query
def clean_songs_missing_id(i: Inputs) -> DataFrame:
    """Repeated tracks whose row without an id must not win."""
    unnumbered = i.songs.where("id % 3 = 0").withColumns(
        {"id": F.lit(None).cast("int"), "popularity": F.lit(-1)}
    )
    return enrich.clean_songs(i.songs.unionByName(unnumbered))


@_query
def reconcile_totals_empty(i: Inputs) -> DataFrame:
    """No plays at all: both totals are 0."""
    return kpi.reconcile_totals(_fact(i).where(F.col("user_id").isNull()))


# --- the daily job: through write_fact, write_table and create_views ---------------------


def _database(i: Inputs) -> views.Tables:
    """A database of this call's own, in the shared folder."""
    name = f"listening_{uuid.uuid4().hex[:12]}"
    i.spark.sql(f"CREATE DATABASE {name} LOCATION '{fresh_folder(i.spark, name)}'")
    return views.Tables(name)


def _daily(
    i: Inputs, streams: DataFrame, day: str, tables: views.Tables, audits: str, keep: bool = False
):
    places = daily.Locations("", "", "", audits)
    return daily.load(
        i.spark, i.songs_dirty, i.users_dirty, streams, places, day, tables=tables,
        keep_partials=keep,
    )


def _two_days(i: Inputs) -> tuple[DataFrame, DataFrame]:
    """The dirty events as two load days would bring them, with a third of them in both. They are
    derived once and stored by third, so a load reads the two it brings."""
    part = F.pmod(F.xxhash64("user_id", "track_id", "listen_time"), F.lit(3))
    folder = fresh_folder(i.spark, "events")
    dealt = i.streams_dirty.withColumn("part", part.cast("int"))
    dealt.write.partitionBy("part").parquet(folder)
    parts = i.spark.read.schema(dealt.schema).parquet(folder)
    return parts.where("part < 2").drop("part"), parts.where("part > 0").drop("part")


@lru_cache(maxsize=8)
def stored(i: Inputs) -> views.Tables:
    """Two load days of the dirty events."""
    tables, audits = _database(i), fresh_folder(i.spark, "audits")
    first, second = _two_days(i)
    _daily(i, first, "2024-02-01", tables, audits)
    _daily(i, second, "2024-02-02", tables, audits)
    return tables


@_query
def stored_fact_two_days(i: Inputs) -> DataFrame:
    """The fact after two load days: a play that landed on both counts once."""
    fact = i.spark.table(stored(i).fact).drop("load_date", "listen_date", "listen_hour")
    return times_as_text(fact, "listen_time").select(
        "user_id", "track_id", "listen_time", "user_name", "track_name", "track_genre"
    )


@_query
def stored_view_genre_kpi(i: Inputs) -> DataFrame:
    return i.spark.table(stored(i).named("view_genre_kpi"))


@_query
def stored_view_hourly_kpi(i: Inputs) -> DataFrame:
    hours = i.spark.table(stored(i).named("view_hourly_kpi"))
    return hours.withColumn("listen_date", F.col("listen_date").cast("string"))


@_query
def stored_view_track_summary(i: Inputs) -> DataFrame:
    return i.spark.table(stored(i).named("view_track_summary"))


@_query
def stored_daily_genre_kpi(i: Inputs) -> DataFrame:
    days = i.spark.table(stored(i).named("view_daily_genre_kpi"))
    return days.withColumn("listen_date", F.col("listen_date").cast("string"))


# --- mergeable partials: no query of these reads a fact ----------------------------------


@lru_cache(maxsize=8)
def stored_partials(i: Inputs) -> views.Tables:
    """The partials of the same two load days, the first of which ran again afterwards."""
    tables, audits = _database(i), fresh_folder(i.spark, "audits")
    first, second = _two_days(i)
    for day, streams in (("01", first), ("02", second), ("01", first)):
        _daily(i, streams, f"2024-02-{day}", tables, audits, keep=True)
    return tables


def _partial(i: Inputs, name: str) -> DataFrame:
    return i.spark.table(stored_partials(i).named(f"partial_{name}"))


@_query
def listeners_bitmap_genre(i: Inputs) -> DataFrame:
    """Exact listeners per genre, from the bitmaps of two load days."""
    return partials.listeners_merged(_partial(i, "genre_listeners"), ["track_genre"])


@_query
def listeners_bitmap_hourly(i: Inputs) -> DataFrame:
    """Exact listeners per hour, from the bitmaps of two load days."""
    hours = partials.listeners_merged(
        _partial(i, "hour_listeners"), ["listen_date", "listen_hour"]
    )
    return hours.withColumn("listen_date", F.col("listen_date").cast("string"))


@_query
def partial_genre_kpi(i: Inputs) -> DataFrame:
    return _partial(i, "genre_kpi")


@_query
def partial_hourly_kpi(i: Inputs) -> DataFrame:
    hours = _partial(i, "hourly_kpi")
    return hours.withColumn("listen_date", F.col("listen_date").cast("string"))


@_query
def partial_daily_genre_kpi(i: Inputs) -> DataFrame:
    days = _partial(i, "daily_genre_kpi")
    return days.withColumn("listen_date", F.col("listen_date").cast("string"))


@_query
def approx_listeners(i: Inputs) -> DataFrame:
    """Listeners per hour of the day: the exact number from bitmaps, whether the sketches' estimate
    is within four standard errors of it, and whether one sketch per hour over the whole fact
    gives the same estimate as those that two load days stored."""
    keys, tables = ["listen_hour"], stored_partials(i)
    exact = partials.listeners_merged(_partial(i, "hour_listeners"), keys)
    many = partials.listeners_estimated(_partial(i, "hour_sketches"), keys)
    whole = partials.hour_sketches(i.spark.table(tables.fact))
    one = partials.listeners_estimated(whole, keys).withColumnRenamed("approx_listeners", "_one")
    error = F.abs(F.col("approx_listeners") - F.col("unique_listeners"))
    return exact.join(many, keys).join(one, keys).select(
        *keys, "unique_listeners",
        (error <= 4 * partials.SKETCH_ERROR * F.col("unique_listeners")).alias("within_error"),
        (F.col("approx_listeners") == F.col("_one")).alias("same_from_one_part"),
    )


@_query
def rerun_audit(i: Inputs) -> DataFrame:
    """The audit folders after a second run of a day in which no user is missing any more."""
    tables, audits = _database(i), fresh_folder(i.spark, "audits")
    _daily(i, i.streams_dirty, "2024-02-01", tables, audits)
    known = i.streams_dirty.join(i.users_dirty.select("user_id").distinct(), "user_id")
    _daily(i, known, "2024-02-01", tables, audits)
    found = [
        read_csv_table(i.spark, f"{audits}/2024-02-01/{name}", schemas.STREAMS).withColumn(
            "audit", F.lit(name)
        )
        for name in ("missing_users", "missing_songs")
        if exists(i.spark, f"{audits}/2024-02-01/{name}")
    ]
    return times_as_text(reduce(DataFrame.unionByName, found), "listen_time")
