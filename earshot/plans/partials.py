"""KPIs kept as mergeable partials per load day, so that reading them opens no fact.

Each load day stores what its plays add to the KPIs: counts and sums, exact listeners as bitmaps
over dense user numbers, and sketches of listeners. A rerun replaces its load day's partials only.
Counts and sums are added on reading, bitmaps are joined bit by bit, sketches are united; a user who
listens on two load days is one listener.

Users are numbered 1, 2, 3, ... as they first appear; a number is never given anew, so a bitmap of
one load day fits those of all others. A bitmap covers 32,768 numbers in 4 kB, mostly zeros that the
files compress. One load runs at a time, as with the fact.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.functions import age_group
from earshot.functions.columns import UNKNOWN_AGE
from earshot.operators.lookup import is_small, lookup_join
from earshot.operators.ordinal import with_ordinal
from earshot.plans.views import Tables
from earshot.session import fresh_folder, remove_folder, stage, together
from earshot.sinks.tables import write_day

# A sketch has 2**12 registers: a standard error of 1.04 / 2**6, or 1.63 %.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)

_HOUR = ["listen_date", "listen_hour"]
_GENRE = ["listen_date", "track_genre"]
# Places of the hourly labels in the views.
LABELS = ["track_genre", "artists", "age_group"]


def genre_plays(fact: DataFrame) -> DataFrame:
    """Plays and the sums behind the means, per date and genre."""
    return fact.groupBy(*_GENRE).agg(
        F.count("listen_time").alias("plays"),
        F.sum("popularity").alias("popularity"),
        F.count("popularity").alias("with_popularity"),
        F.sum("duration_ms").alias("duration_ms"),
        F.count("duration_ms").alias("with_duration"),
    )


def track_plays(fact: DataFrame) -> DataFrame:
    """Plays per date, genre and track."""
    return fact.groupBy(*_GENRE, "track_id").agg(F.count("*").alias("plays"))


def hour_labels(fact: DataFrame) -> DataFrame:
    """Plays per hour and label; every play counts once for each kind of label."""
    aged = fact.withColumn("age_group", age_group(F.col("user_age"), UNKNOWN_AGE))
    return (
        aged.select(*_HOUR, F.posexplode(F.array(*LABELS)).alias("kind", "label"))
        .groupBy(*_HOUR, "kind", "label")
        .agg(F.count("*").alias("plays"))
    )


def listeners(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Per group and bucket of user numbers the bitmap of those that occur. ``pairs`` has the keys
    and ``number``.

    Repeats go before the bitmaps are made, spread by (group, user), and a group's bucket then has
    32,768 rows at most, however many plays it has. Rows are brought together before the first
    bitmap is made, as a bitmap takes 4 kB for each group and bucket that a task meets.
    """
    placed = pairs.select(*keys, "number").distinct().withColumns(
        {
            "bucket": F.bitmap_bucket_number("number"),
            "position": F.bitmap_bit_position("number"),
        }
    )
    together = placed.repartition(*keys, "bucket")
    return together.groupBy(*keys, "bucket").agg(
        F.bitmap_construct_agg("position").alias("listeners")
    )


def hour_sketches(fact: DataFrame) -> DataFrame:
    """A sketch of the listeners per hour."""
    return fact.groupBy(*_HOUR).agg(
        F.hll_sketch_agg("user_id", F.lit(SKETCH_BITS)).alias("sketch")
    )


def number_users(
    spark: SparkSession, users: DataFrame, table: str, path: str | None, folder: str
) -> DataFrame:
    """user_id, number of ``users`` (distinct). Those without a number are given the next ones and
    appended to ``table``; a number once given stays."""
    if not spark.catalog.tableExists(table):
        kind = users.schema["user_id"].dataType.simpleString()
        spark.sql(
            f"CREATE TABLE {table} (user_id {kind}, number BIGINT) USING parquet"
            + (f" LOCATION '{path}'" if path else "")
        )
    new = stage(users.join(spark.table(table), "user_id", "left_anti"), f"{folder}/new-users")
    if not new.isEmpty():
        taken = spark.table(table).agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
        numbered = with_ordinal(new, "number").withColumn("number", F.col("number") + 1 + taken)
        numbered.select("user_id", "number").write.insertInto(table)
    return users.join(spark.table(table), "user_id")


def store_day(
    spark: SparkSession, tables: Tables, day: dt.date | str, path: str | None = None
) -> None:
    """Bring the partials of one load day up to date with the stored fact, the only thing read.

    The day's users are numbered first, as many as are new; their numbers join the day's plays
    as any lookup does. ``path`` keeps the tables' files outside the warehouse folder.
    """
    day = dt.date.fromisoformat(str(day))
    folder = fresh_folder(spark, f"partials-{day}")
    fact = spark.table(tables.fact).where(F.col("load_date") == F.lit(day))

    def location(table: str) -> str | None:
        return f"{path}/{table}" if path else None

    def store(name: str, df: DataFrame) -> None:
        write_day(df, tables.named(name), day, location(name))

    # One row per hour, genre and listener, however many plays.
    pairs = stage(fact.select(*_HOUR, "track_genre", "user_id").distinct(), f"{folder}/pairs")
    users = pairs.select("user_id").distinct()
    numbers = stage(
        number_users(spark, users, tables.named("user_numbers"), location("user_numbers"), folder),
        f"{folder}/numbers",
    )
    numbered = stage(
        lookup_join(pairs, numbers, "user_id", "inner", is_small(numbers)), f"{folder}/numbered"
    )
    together(
        spark,
        lambda: store("partial_genre_plays", genre_plays(fact)),
        lambda: store("partial_track_plays", track_plays(fact)),
        lambda: store("partial_hour_labels", hour_labels(fact)),
        lambda: store("partial_genre_listeners", listeners(numbered, _GENRE)),
        lambda: store("partial_hour_listeners", listeners(numbered, _HOUR)),
        lambda: store("partial_hour_sketches", hour_sketches(pairs)),
    )
    remove_folder(spark, folder)


def listeners_merged(stored: DataFrame, keys: list[str]) -> DataFrame:
    """Exact listeners per group of stored bitmaps: unique_listeners."""
    merged = stored.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("listeners").alias("listeners"))
    return merged.groupBy(*keys).agg(
        F.sum(F.bitmap_count("listeners")).alias("unique_listeners")
    )


def listeners_estimated(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Estimated listeners per group of stored sketches: approx_listeners, with a standard error
    of ``SKETCH_ERROR``. United from one sketch or many, the estimate is the same."""
    # A union of a single sketch would keep that sketch's own, order-dependent estimate.
    merged = F.hll_union_agg("sketch", F.lit(False))
    return sketches.groupBy(*keys).agg(
        F.hll_sketch_estimate(F.hll_union(merged, merged)).alias("approx_listeners")
    )
