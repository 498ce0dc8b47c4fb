"""The KPI views as SQL text over the stored tables.

The views hold text only; each query plans them afresh on the tables as they are then.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

GENRE_KPI = """
WITH plays AS (
  SELECT track_genre,
         count(listen_time) AS total_streams,
         avg(popularity) AS avg_popularity,
         count(DISTINCT user_id) AS unique_listeners,
         avg(duration_ms) AS avg_duration
  FROM {fact} GROUP BY track_genre
), catalogue AS (
  SELECT track_genre,
         count(track_id) AS total_track,
         sum(CAST(explicit AS INT)) AS total_explicit_track,
         try_divide(sum(CAST(explicit AS INT)), count(track_id)) AS explicit_ratio
  FROM {songs} GROUP BY track_genre
), placed AS (
  SELECT track_genre, track_id,
         row_number() OVER (PARTITION BY track_genre
                            ORDER BY n DESC, track_id ASC NULLS LAST) AS place
  FROM (SELECT track_genre, track_id, count(*) AS n FROM {fact} GROUP BY track_genre, track_id)
)
SELECT plays.*, total_track, total_explicit_track, explicit_ratio,
       track_id AS most_popular_track_id
FROM plays
LEFT JOIN catalogue ON plays.track_genre = catalogue.track_genre
LEFT JOIN placed ON plays.track_genre = placed.track_genre AND place = 1
"""

# Ages run through the same ranges as the age_group function; others compete as 'Unknown'.
HOURLY_KPI = """
WITH totals AS (
  SELECT listen_date, listen_hour,
         count(*) AS total_streams,
         count(DISTINCT user_id) AS unique_listeners
  FROM {fact} GROUP BY listen_date, listen_hour
), labelled AS (
  SELECT listen_date, listen_hour,
         posexplode(array(
           track_genre, artists,
           CASE WHEN user_age >= 10 AND user_age < 100
                THEN concat_ws('-', floor(user_age / 10) * 10, floor(user_age / 10) * 10 + 9)
                ELSE 'Unknown' END)) AS (kind, label)
  FROM {fact}
), placed AS (
  SELECT listen_date, listen_hour, kind,
         named_struct('n', -count(*), 'none', label IS NULL, 'label', label) AS place
  FROM labelled GROUP BY listen_date, listen_hour, kind, label
), tops AS (
  SELECT listen_date, listen_hour,
         (min(place) FILTER (WHERE kind = 0)).label AS top_genre,
         (min(place) FILTER (WHERE kind = 1)).label AS top_artist,
         (min(place) FILTER (WHERE kind = 2)).label AS top_age_group
  FROM placed GROUP BY listen_date, listen_hour
)
SELECT totals.*, top_genre, top_artist, top_age_group
FROM totals
LEFT JOIN tops ON totals.listen_date = tops.listen_date AND totals.listen_hour = tops.listen_hour
"""

DAILY_GENRE_KPI = """
WITH plays AS (
  SELECT listen_date, track_genre,
         count(listen_time) AS total_streams,
         avg(popularity) AS avg_popularity,
         count(DISTINCT user_id) AS unique_listeners,
         avg(duration_ms) AS avg_duration
  FROM {fact} GROUP BY listen_date, track_genre
), placed AS (
  SELECT listen_date, track_genre, track_id,
         row_number() OVER (PARTITION BY listen_date, track_genre
                            ORDER BY n DESC, track_id ASC NULLS LAST) AS place
  FROM (SELECT listen_date, track_genre, track_id, count(*) AS n
        FROM {fact} GROUP BY listen_date, track_genre, track_id)
)
SELECT plays.*, track_id
FROM plays
LEFT JOIN placed ON plays.listen_date = placed.listen_date
                AND plays.track_genre = placed.track_genre AND place = 1
"""

TRACK_SUMMARY = """
WITH plays AS (
  SELECT track_id, count(*) AS total_streams, count(DISTINCT user_id) AS unique_listeners
  FROM {fact} GROUP BY track_id
)
SELECT plays.track_id, track_name, artists, track_genre, popularity,
       total_streams, unique_listeners
FROM plays LEFT JOIN {songs} about ON plays.track_id = about.track_id
"""

VIEWS = {
    "view_genre_kpi": GENRE_KPI,
    "view_daily_genre_kpi": DAILY_GENRE_KPI,
    "view_hourly_kpi": HOURLY_KPI,
    "view_track_summary": TRACK_SUMMARY,
}


# The same KPIs over the partials that load days store (``partials``). No fact is read.
PARTIAL_GENRE_KPI = """
WITH plays AS (
  SELECT track_genre, sum(plays) AS total_streams,
         try_divide(sum(popularity), sum(with_popularity)) AS avg_popularity,
         try_divide(sum(duration_ms), sum(with_duration)) AS avg_duration
  FROM {genre_plays} GROUP BY track_genre
), listeners AS (
  SELECT track_genre, sum(bitmap_count(merged)) AS unique_listeners
  FROM (SELECT track_genre, bucket, bitmap_or_agg(listeners) AS merged
        FROM {genre_listeners} GROUP BY track_genre, bucket)
  GROUP BY track_genre
), catalogue AS (
  SELECT track_genre,
         count(track_id) AS total_track,
         sum(CAST(explicit AS INT)) AS total_explicit_track,
         try_divide(sum(CAST(explicit AS INT)), count(track_id)) AS explicit_ratio
  FROM {songs} GROUP BY track_genre
), placed AS (
  SELECT track_genre, track_id,
         row_number() OVER (PARTITION BY track_genre
                            ORDER BY n DESC, track_id ASC NULLS LAST) AS place
  FROM (SELECT track_genre, track_id, sum(plays) AS n
        FROM {track_plays} GROUP BY track_genre, track_id)
)
SELECT plays.track_genre, total_streams, avg_popularity, unique_listeners, avg_duration,
       total_track, total_explicit_track, explicit_ratio, track_id AS most_popular_track_id
FROM plays
LEFT JOIN listeners ON plays.track_genre <=> listeners.track_genre
LEFT JOIN catalogue ON plays.track_genre = catalogue.track_genre
LEFT JOIN placed ON plays.track_genre = placed.track_genre AND place = 1
"""

PARTIAL_DAILY_GENRE_KPI = """
WITH plays AS (
  SELECT listen_date, track_genre, sum(plays) AS total_streams,
         try_divide(sum(popularity), sum(with_popularity)) AS avg_popularity,
         try_divide(sum(duration_ms), sum(with_duration)) AS avg_duration
  FROM {genre_plays} GROUP BY listen_date, track_genre
), listeners AS (
  SELECT listen_date, track_genre, sum(bitmap_count(merged)) AS unique_listeners
  FROM (SELECT listen_date, track_genre, bucket, bitmap_or_agg(listeners) AS merged
        FROM {genre_listeners} GROUP BY listen_date, track_genre, bucket)
  GROUP BY listen_date, track_genre
), placed AS (
  SELECT listen_date, track_genre, track_id,
         row_number() OVER (PARTITION BY listen_date, track_genre
                            ORDER BY n DESC, track_id ASC NULLS LAST) AS place
  FROM (SELECT listen_date, track_genre, track_id, sum(plays) AS n
        FROM {track_plays} GROUP BY listen_date, track_genre, track_id)
)
SELECT plays.listen_date, plays.track_genre, total_streams, avg_popularity, unique_listeners,
       avg_duration, track_id
FROM plays
LEFT JOIN listeners ON plays.listen_date = listeners.listen_date
                   AND plays.track_genre <=> listeners.track_genre
LEFT JOIN placed ON plays.listen_date = placed.listen_date
                AND plays.track_genre = placed.track_genre AND place = 1
"""

# Every play has one label of the first kind, so their plays add up to the hour's.
PARTIAL_HOURLY_KPI = """
WITH placed AS (
  SELECT listen_date, listen_hour, kind, sum(plays) AS n,
         named_struct('n', -sum(plays), 'none', label IS NULL, 'label', label) AS place
  FROM {hour_labels} GROUP BY listen_date, listen_hour, kind, label
), tops AS (
  SELECT listen_date, listen_hour,
         sum(n) FILTER (WHERE kind = 0) AS total_streams,
         (min(place) FILTER (WHERE kind = 0)).label AS top_genre,
         (min(place) FILTER (WHERE kind = 1)).label AS top_artist,
         (min(place) FILTER (WHERE kind = 2)).label AS top_age_group
  FROM placed GROUP BY listen_date, listen_hour
), listeners AS (
  SELECT listen_date, listen_hour, sum(bitmap_count(merged)) AS unique_listeners
  FROM (SELECT listen_date, listen_hour, bucket, bitmap_or_agg(listeners) AS merged
        FROM {hour_listeners} GROUP BY listen_date, listen_hour, bucket)
  GROUP BY listen_date, listen_hour
)
SELECT tops.listen_date, tops.listen_hour, total_streams, unique_listeners,
       top_genre, top_artist, top_age_group
FROM tops
LEFT JOIN listeners ON tops.listen_date = listeners.listen_date
                   AND tops.listen_hour = listeners.listen_hour
"""

PARTIAL_VIEWS = {
    "partial_genre_kpi": PARTIAL_GENRE_KPI,
    "partial_daily_genre_kpi": PARTIAL_DAILY_GENRE_KPI,
    "partial_hourly_kpi": PARTIAL_HOURLY_KPI,
}
_PARTIALS = ("genre_plays", "track_plays", "hour_labels", "genre_listeners", "hour_listeners")


@dataclass(frozen=True)
class Tables:
    """Names of the stored tables, with the database in front where there is one."""

    database: str | None = None

    def named(self, table: str) -> str:
        return f"{self.database}.{table}" if self.database else table

    @property
    def fact(self) -> str:
        return self.named("fact_streams")

    @property
    def users(self) -> str:
        return self.named("dim_users")

    @property
    def songs(self) -> str:
        return self.named("dim_songs")


def create_views(
    spark: SparkSession, tables: Tables = Tables(), partials: bool = False
) -> list[str]:
    """Create or replace the views beside the tables, with ``partials`` those over the stored
    partials too; returns their names."""
    stored = {name: tables.named(f"partial_{name}") for name in _PARTIALS}
    texts = VIEWS | (PARTIAL_VIEWS if partials else {})
    for name, text in texts.items():
        select = text.format(fact=tables.fact, songs=tables.songs, **stored)
        spark.sql(f"CREATE OR REPLACE VIEW {tables.named(name)} AS {select}")
    return [tables.named(name) for name in texts]
