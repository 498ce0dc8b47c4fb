"""KPIs over the fact table and the song dimension.

Every aggregate combines on the map side, and an exact distinct count is spread by
(group, user), so one genre, hour or track with a third of all rows is no hot spot. Joins
happen after grouping, between frames of one row per genre, hour or track.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions import age_group
from earshot.functions.columns import UNKNOWN_AGE
from earshot.operators.top import top_one

_HOUR = ["listen_date", "listen_hour"]


def _genre_plays(fact: DataFrame, keys: list[str]) -> DataFrame:
    return fact.groupBy(*keys).agg(
        F.count("listen_time").alias("total_streams"),
        F.avg("popularity").alias("avg_popularity"),
        F.count_distinct("user_id").alias("unique_listeners"),
        F.avg("duration_ms").alias("avg_duration"),
    )


def _top_track(fact: DataFrame, keys: list[str]) -> DataFrame:
    plays = fact.groupBy(*keys, "track_id").agg(F.count("*").alias("total_streams"))
    return top_one(plays, keys, "total_streams", F.col("track_id"))


def genre_streams(fact: DataFrame) -> DataFrame:
    """Plays, listeners and play-weighted means per genre."""
    return _genre_plays(fact, ["track_genre"])


def genre_explicit(songs: DataFrame) -> DataFrame:
    """Tracks, explicit tracks and their ratio per genre of the song dimension."""
    flagged = F.sum(F.col("explicit").cast("int"))
    return songs.groupBy("track_genre").agg(
        F.count("track_id").alias("total_track"),
        flagged.alias("total_explicit_track"),
        F.try_divide(flagged, F.count("track_id")).alias("explicit_ratio"),
    )


def most_popular_track(fact: DataFrame) -> DataFrame:
    """track_genre, track_id, total_streams of the most played track per genre."""
    return _top_track(fact, ["track_genre"])


def most_popular_track_daily(fact: DataFrame) -> DataFrame:
    """The same per date and genre."""
    return _top_track(fact, ["listen_date", "track_genre"])


def genre_kpi(fact: DataFrame, songs: DataFrame) -> DataFrame:
    """One row per genre that was played."""
    top = most_popular_track(fact).select(
        "track_genre", F.col("track_id").alias("most_popular_track_id")
    )
    return (
        genre_streams(fact)
        .join(genre_explicit(songs), "track_genre", "left")
        .join(top, "track_genre", "left")
    )


def daily_genre_kpi(fact: DataFrame) -> DataFrame:
    """One row per date and genre, with that day's most played track."""
    keys = ["listen_date", "track_genre"]
    top = most_popular_track_daily(fact).select(*keys, "track_id")
    return _genre_plays(fact, keys).join(top, keys, "left")


def hourly_totals(fact: DataFrame) -> DataFrame:
    """Plays and listeners per hour."""
    return fact.groupBy(*_HOUR).agg(
        F.count("*").alias("total_streams"),
        F.count_distinct("user_id").alias("unique_listeners"),
    )


def _top_hourly(fact: DataFrame, label: str) -> DataFrame:
    plays = fact.groupBy(*_HOUR, label).agg(F.count("*").alias("total_streams"))
    return top_one(plays, _HOUR, "total_streams", F.col(label))


def _with_age_group(fact: DataFrame) -> DataFrame:
    return fact.withColumn("age_group", age_group(F.col("user_age"), UNKNOWN_AGE))


def top_genre_hourly(fact: DataFrame) -> DataFrame:
    return _top_hourly(fact, "track_genre")


def top_artist_hourly(fact: DataFrame) -> DataFrame:
    return _top_hourly(fact, "artists")


def top_age_group_hourly(fact: DataFrame) -> DataFrame:
    """Listeners outside 10 to 99 compete as 'Unknown'."""
    return _top_hourly(_with_age_group(fact), "age_group")


def hourly_tops(fact: DataFrame) -> DataFrame:
    """Top genre, artist and age group per hour, in one pass over the fact.

    Every play counts once for each of its three labels, in one shuffle of partial counts; a
    second one takes each task's best label per hour. Ties go to the lowest label, null last.
    Dates pass through unchanged, so a filter on them still prunes a stored fact's partitions
    (it would not pass grouping sets).
    """
    labels = F.array("track_genre", "artists", "age_group")
    plays = (
        _with_age_group(fact)
        .select(*_HOUR, F.posexplode(labels).alias("_kind", "_label"))
        .groupBy(*_HOUR, "_kind", "_label")
        .agg(F.count("*").alias("_plays"))
    )
    label = F.col("_label")
    place = F.struct((-F.col("_plays")).alias("n"), label.isNull().alias("none"), label)

    def top(kind: int) -> Column:
        return F.min(F.when(F.col("_kind") == kind, place))["_label"]

    return plays.groupBy(*_HOUR).agg(
        top(0).alias("top_genre"), top(1).alias("top_artist"), top(2).alias("top_age_group")
    )


def hourly_kpi(fact: DataFrame) -> DataFrame:
    """One row per hour: totals and the three tops.

    Two scans of a stored fact that share no column but the hour: the totals read users, the
    tops read labels.
    """
    return hourly_totals(fact).join(hourly_tops(fact), _HOUR, "left")


def track_summary(fact: DataFrame, songs: DataFrame) -> DataFrame:
    """Plays and listeners per played track, with the track's columns where it is known."""
    plays = fact.groupBy("track_id").agg(
        F.count("*").alias("total_streams"),
        F.count_distinct("user_id").alias("unique_listeners"),
    )
    about = songs.select("track_id", "track_name", "artists", "track_genre", "popularity")
    return plays.join(about, "track_id", "left").select(
        "track_id",
        "track_name",
        "artists",
        "track_genre",
        "popularity",
        "total_streams",
        "unique_listeners",
    )


def track_popularity(fact: DataFrame, songs: DataFrame, top: int | None = None) -> DataFrame:
    """Tracks by plays, most played first; ``top`` keeps that many."""
    ranked = track_summary(fact, songs).orderBy(F.col("total_streams").desc(), F.col("track_id"))
    return ranked if top is None else ranked.limit(top)


def reconcile_totals(fact: DataFrame) -> DataFrame:
    """One row: plays summed over days and genres, plays summed over genres, and whether
    they agree."""

    def total(keys: list[str], daily: bool) -> DataFrame:
        plays = fact.groupBy(*keys).agg(F.count("listen_time").alias("plays"))
        summed = plays.agg(F.sum("plays").alias("plays"))
        return summed.select("plays", F.lit(daily).alias("daily"))

    both = total(["listen_date", "track_genre"], True).unionByName(total(["track_genre"], False))
    none = F.lit(0).cast("long")
    sums = both.agg(
        F.coalesce(F.sum(F.when(F.col("daily"), F.col("plays"))), none).alias("daily_total"),
        F.coalesce(F.sum(F.when(~F.col("daily"), F.col("plays"))), none).alias("overall_total"),
    )
    return sums.withColumn("matches", F.col("daily_total") == F.col("overall_total"))
