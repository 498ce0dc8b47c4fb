"""DuckDB SQL with the same results as the registered queries, on the same tables."""

from __future__ import annotations

_STREAMS = """
events_mapped AS (
  SELECT event_id, user_id + 1 AS user_id,
         'T' || json_extract_string(props, '$.k') AS track_id, ts AS listen_time
  FROM events
), streams AS (SELECT user_id, track_id, listen_time FROM events_mapped)"""

_USERS = """
users AS (
  SELECT c_custkey + 1 AS user_id, c_name AS user_name,
         CAST(5 + c_custkey % 100 AS INT) AS user_age, n_name AS user_country,
         TIMESTAMP '2024-06-10 00:00:00' + to_days(CAST(c_custkey % 30 AS INT)) AS created_at
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
)"""

_SONGS = """
songs AS (
  SELECT p_partkey AS id, 'T' || p_partkey AS track_id, p_brand AS artists,
         'album' AS album_name, p_name AS track_name, p_size AS popularity,
         CAST(floor(p_retailprice * 250) AS INT) AS duration_ms,
         CAST(CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END AS INT) AS explicit,
         CAST(CASE WHEN p_partkey % 41 = 0 THEN 0 ELSE p_size * 4 END AS DOUBLE) AS tempo,
         p_type AS track_genre
  FROM part
)"""

_STREAMS_DIRTY = """
spoiled AS (
  SELECT event_id,
         CASE WHEN event_id % 17 = 0 THEN NULL
              WHEN event_id % 13 = 0 THEN user_id + 1000000 ELSE user_id END AS user_id,
         CASE WHEN event_id % 19 = 0 THEN NULL
              WHEN event_id % 11 = 0 THEN 'X' || track_id ELSE track_id END AS track_id,
         CASE WHEN event_id % 23 = 0 THEN NULL ELSE listen_time END AS listen_time
  FROM events_mapped
), streams_dirty AS (
  SELECT user_id, track_id, listen_time FROM spoiled
  UNION ALL
  SELECT user_id, track_id, listen_time FROM spoiled WHERE event_id % 10 = 0
)"""

_USERS_DIRTY = """
users_spoiled AS (
  SELECT user_id, user_name,
         CASE WHEN user_id % 9 = 0 THEN NULL ELSE user_age END AS user_age,
         CASE WHEN user_id % 7 = 0 THEN NULL ELSE user_country END AS user_country, created_at
  FROM users
), users_dirty AS (
  SELECT * FROM users_spoiled
  UNION ALL
  SELECT * REPLACE (user_name || ' again' AS user_name,
                    created_at + INTERVAL 1 DAY AS created_at)
  FROM users_spoiled WHERE user_id % 40 = 0
)"""

_SONGS_DIRTY = """
songs_dirty AS (
  SELECT * REPLACE (CASE WHEN id % 7 = 0 THEN NULL ELSE track_genre END AS track_genre)
  FROM songs
  UNION ALL
  SELECT * REPLACE (id + 1000000 AS id, popularity + 1 AS popularity)
  FROM songs WHERE id % 50 = 0
)"""

_CLEAN_STREAMS = """
clean_streams AS (
  SELECT DISTINCT coalesce(user_id, 0) AS user_id, coalesce(track_id, 'Unknown') AS track_id,
         coalesce(listen_time, TIMESTAMP '9999-12-31 00:00:00') AS listen_time
  FROM streams_dirty
)"""

_CLEAN_USERS = """
clean_users AS (
  SELECT user_id, coalesce(user_name, 'Unknown') AS user_name,
         coalesce(user_age, 0) AS user_age, coalesce(user_country, 'Unknown') AS user_country,
         created_at
  FROM users_dirty
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY created_at, user_name) = 1
)"""

_CLEAN_SONGS = """
clean_songs AS (
  SELECT * REPLACE (coalesce(track_genre, 'Unknown') AS track_genre)
  FROM songs_dirty
  QUALIFY row_number() OVER (PARTITION BY track_id ORDER BY id) = 1
)"""

_INPUT_DIRTY = [_STREAMS, _USERS, _SONGS, _STREAMS_DIRTY, _USERS_DIRTY, _SONGS_DIRTY]
_CLEANED = [*_INPUT_DIRTY, _CLEAN_STREAMS, _CLEAN_USERS, _CLEAN_SONGS]

_AGE = """CASE WHEN user_age BETWEEN 10 AND 99
    THEN (user_age // 10 * 10) || '-' || (user_age // 10 * 10 + 9) ELSE '{other}' END"""


def _text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def _fact(streams: str, users: str, songs: str) -> str:
    return f"""
fact AS (
  SELECT s.user_id, s.track_id, s.listen_time,
         u.user_name, u.user_age, u.user_country, u.created_at,
         g.id, g.artists, g.album_name, g.track_name, g.popularity, g.duration_ms, g.explicit,
         g.tempo, g.track_genre,
         CAST(s.listen_time AS DATE) AS listen_date,
         CAST(extract(HOUR FROM s.listen_time) AS INTEGER) AS listen_hour
  FROM {streams} s JOIN {users} u ON s.user_id = u.user_id
                   JOIN {songs} g ON s.track_id = g.track_id
)"""


_FACT = [_STREAMS, _USERS, _SONGS, _fact("streams", "users", "songs")]
_FACT_DIRTY = [*_CLEANED, _fact("clean_streams", "clean_users", "clean_songs")]


def _sql(parts: list[str], select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


def _dim_users(users: str) -> str:
    return f"""
SELECT *, {_AGE.format(other='nan')} AS age_group,
       CAST(created_at AS DATE) BETWEEN DATE '2024-06-19' AND DATE '2024-06-25' AS is_new_weekly
FROM {users}"""


def _dim_songs(songs: str) -> str:
    return f"""
SELECT * EXCLUDE (id), duration_ms / 1000 AS duration_s,
       (duration_ms // 60000) || ':' || lpad(CAST(duration_ms % 60000 // 1000 AS VARCHAR), 2, '0')
         AS duration_min_sec,
       CASE WHEN tempo > 0 AND tempo <= 90 THEN 'slow' WHEN tempo > 90 AND tempo <= 120
            THEN 'medium' WHEN tempo > 120 THEN 'fast' ELSE 'nan' END AS tempo_level
FROM {songs}"""


def _genre_plays(keys: str) -> str:
    return f"""
SELECT {keys}, count(listen_time) AS total_streams, avg(popularity) AS avg_popularity,
       count(DISTINCT user_id) AS unique_listeners, avg(duration_ms) AS avg_duration
FROM fact GROUP BY {keys}"""


def _top(keys: str, label: str, source: str = "fact") -> str:
    return f"""
SELECT {keys}, {label}, count(*) AS total_streams FROM {source} GROUP BY {keys}, {label}
QUALIFY row_number() OVER (PARTITION BY {keys}
                           ORDER BY count(*) DESC, {label} ASC NULLS LAST) = 1"""


def _genre_explicit(songs: str) -> str:
    return f"""
SELECT track_genre, count(track_id) AS total_track,
       CAST(sum(explicit) AS BIGINT) AS total_explicit_track,
       sum(explicit) / nullif(count(track_id), 0) AS explicit_ratio
FROM {songs} GROUP BY track_genre"""


def _genre_kpi(songs: str) -> str:
    return f"""
SELECT p.*, e.total_track, e.total_explicit_track, e.explicit_ratio,
       t.track_id AS most_popular_track_id
FROM ({_genre_plays('track_genre')}) p
LEFT JOIN ({_genre_explicit(songs)}) e ON p.track_genre = e.track_genre
LEFT JOIN ({_top('track_genre', 'track_id')}) t ON p.track_genre = t.track_genre"""


_DAILY_GENRE_KPI = f"""
SELECT p.*, t.track_id
FROM ({_genre_plays('listen_date, track_genre')}) p
LEFT JOIN ({_top('listen_date, track_genre', 'track_id')}) t
  ON p.listen_date = t.listen_date AND p.track_genre = t.track_genre"""

_HOUR = "listen_date, listen_hour"
_AGED = f"(SELECT *, {_AGE.format(other='Unknown')} AS age_group FROM fact)"

_HOURLY_TOTALS = f"""
SELECT {_HOUR}, count(*) AS total_streams, count(DISTINCT user_id) AS unique_listeners
FROM fact GROUP BY {_HOUR}"""

_HOURLY_KPI = f"""
SELECT h.*, g.track_genre AS top_genre, a.artists AS top_artist, b.age_group AS top_age_group
FROM ({_HOURLY_TOTALS}) h
LEFT JOIN ({_top(_HOUR, 'track_genre')}) g
  ON h.listen_date = g.listen_date AND h.listen_hour = g.listen_hour
LEFT JOIN ({_top(_HOUR, 'artists')}) a
  ON h.listen_date = a.listen_date AND h.listen_hour = a.listen_hour
LEFT JOIN ({_top(_HOUR, 'age_group', _AGED)}) b
  ON h.listen_date = b.listen_date AND h.listen_hour = b.listen_hour"""


def _track_summary(songs: str) -> str:
    return f"""
SELECT p.track_id, d.track_name, d.artists, d.track_genre, d.popularity,
       p.total_streams, p.unique_listeners
FROM (SELECT track_id, count(*) AS total_streams, count(DISTINCT user_id) AS unique_listeners
      FROM fact GROUP BY track_id) p
LEFT JOIN {songs} d ON p.track_id = d.track_id"""


_RECONCILE = """
SELECT CAST(d AS BIGINT) AS daily_total, CAST(o AS BIGINT) AS overall_total, d = o AS matches
FROM (SELECT (SELECT coalesce(sum(n), 0) FROM (SELECT count(listen_time) AS n FROM fact
                                               GROUP BY listen_date, track_genre)) AS d,
             (SELECT coalesce(sum(n), 0) FROM (SELECT count(listen_time) AS n FROM fact
                                               GROUP BY track_genre)) AS o)"""


def _nulls(table: str, columns: list[str]) -> list[str]:
    return [
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
        f"count(*) FILTER ({c} IS NULL) AS missing FROM {table}_dirty"
        for c in columns
    ]


_STREAM_COLUMNS = ["user_id", "track_id", "listen_time"]
_USER_COLUMNS = ["user_id", "user_name", "user_age", "user_country", "created_at"]
_SONG_COLUMNS = [
    "id", "track_id", "artists", "album_name", "track_name", "popularity", "duration_ms",
    "explicit", "tempo", "track_genre",
]

_NULL_PROFILE = " UNION ALL ".join(
    _nulls("streams", _STREAM_COLUMNS)
    + _nulls("users", _USER_COLUMNS)
    + _nulls("songs", _SONG_COLUMNS)
)

_JOINED_COLUMNS = """
  u.user_name, u.user_age, u.user_country, u.created_at,
  g.id, g.artists, g.album_name, g.track_name, g.popularity, g.duration_ms, g.explicit,
  g.tempo, g.track_genre"""


def _joined(kind: str) -> str:
    return f"""
SELECT s.user_id, s.track_id, {_text('s.listen_time')} AS listen_time, {_JOINED_COLUMNS}
FROM clean_streams s {kind} JOIN clean_users u ON s.user_id = u.user_id
                     {kind} JOIN clean_songs g ON s.track_id = g.track_id"""


def _unmatched(lookup: str, key: str) -> str:
    return f"""
FROM clean_streams s WHERE NOT EXISTS (SELECT 1 FROM {lookup} x WHERE x.{key} = s.{key})"""


_AUDIT_ROWS = f"SELECT user_id, track_id, {_text('listen_time')} AS listen_time"


_EVENT = f"""'{{"user_id":' || user_id || ',"track_id":"' || track_id
  || '","listen_time":"' || {_text('listen_time')} || '"}}' AS value"""


def _any_missing(table: str, columns: list[str]) -> str:
    found = " OR ".join(f"{c} IS NULL" for c in columns)
    return f"SELECT '{table}' AS table_name, count(*) FILTER ({found}) > 0 AS missing FROM {table}"


# Database types by column; those of columns the given tables don't fill come last.
_SONG_TYPES = {
    "id": "INT", "track_id": "VARCHAR(255)", "artists": "VARCHAR(255)",
    "album_name": "VARCHAR(255)", "track_name": "VARCHAR(255)", "popularity": "INT",
    "duration_ms": "INT", "explicit": "BOOLEAN", "tempo": "DOUBLE", "track_genre": "VARCHAR(255)",
    "danceability": "DOUBLE", "energy": "DOUBLE", "key": "INT", "loudness": "DOUBLE",
    "mode": "INT", "speechiness": "DOUBLE", "acousticness": "DOUBLE",
    "instrumentalness": "DOUBLE", "liveness": "DOUBLE", "valence": "DOUBLE",
    "time_signature": "INT",
}
_USER_TYPES = {
    "user_id": "INT", "user_name": "VARCHAR(255)", "user_age": "INT",
    "user_country": "VARCHAR(255)", "created_at": "VARCHAR(255)",
}


def _column_types(table: str, types: dict[str, str], have: list[str]) -> list[str]:
    return [
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, '{kind}' AS type, "
        f"{f'count({c})' if c in have else 'count(NULL)'} AS filled FROM {table}"
        for c, kind in types.items()
    ]


def all_oracles() -> dict[str, str]:
    clean_streams = f"{_AUDIT_ROWS} FROM clean_streams"
    return {
        "clean_streams": _sql(_CLEANED, clean_streams),
        "clean_users": _sql(_CLEANED, "SELECT * FROM clean_users"),
        "clean_songs": _sql(_CLEANED, "SELECT * FROM clean_songs"),
        "union_streams": _sql(
            _INPUT_DIRTY, "SELECT * FROM streams UNION ALL SELECT * FROM streams_dirty"
        ),
        "null_profile": _sql(_INPUT_DIRTY, _NULL_PROFILE),
        "duplicate_profile": _sql(
            _INPUT_DIRTY,
            f"{_AUDIT_ROWS}, count(*) AS copies FROM streams_dirty "
            "GROUP BY user_id, track_id, streams_dirty.listen_time HAVING count(*) > 1",
        ),
        "duplicate_profile_songs": _sql(
            _INPUT_DIRTY,
            "SELECT track_id, count(*) AS copies FROM songs_dirty "
            "GROUP BY track_id HAVING count(*) > 1",
        ),
        "profile": _sql(
            _INPUT_DIRTY,
            " UNION ALL ".join(
                f"SELECT '{t}' AS table_name, count(*) AS row_count, "
                f"CAST({n} AS INTEGER) AS column_count FROM {t}_dirty"
                for t, n in (("streams", 3), ("users", 5), ("songs", 10))
            ),
        ),
        "preview": _sql([_SONGS], "SELECT * FROM songs ORDER BY id LIMIT 10"),
        "enrich_streams": _sql(_CLEANED, _joined("INNER")),
        "enrich_streams_left": _sql(_CLEANED, _joined("LEFT")),
        "enrich_streams_sliced": _sql(_CLEANED, _joined("INNER")),
        "audit_missing_users": _sql(
            _CLEANED, _AUDIT_ROWS + _unmatched("clean_users", "user_id")
        ),
        "audit_missing_songs": _sql(
            _CLEANED, _AUDIT_ROWS + _unmatched("clean_songs", "track_id")
        ),
        "audit_counts": _sql(
            _CLEANED,
            "SELECT 'missing_users' AS audit, count(*) AS events"
            + _unmatched("clean_users", "user_id")
            + " UNION ALL SELECT 'missing_songs', count(*)"
            + _unmatched("clean_songs", "track_id"),
        ),
        "fact_streams": _sql(_FACT, "SELECT * FROM fact"),
        "fact_streams_dirty": _sql(
            _FACT_DIRTY,
            f"SELECT * REPLACE ({_text('listen_time')} AS listen_time) FROM fact",
        ),
        "fact_streams_slim": _sql(
            _FACT,
            "SELECT user_id, track_id, listen_time, listen_date, listen_hour, artists, "
            "track_name, track_genre FROM fact",
        ),
        "dim_users": _sql([_USERS], _dim_users("users")),
        "dim_users_dirty": _sql(_CLEANED, _dim_users("clean_users")),
        "dim_songs": _sql([_SONGS], _dim_songs("songs")),
        "dim_songs_dirty": _sql(_CLEANED, _dim_songs("clean_songs")),
        "genre_streams": _sql(_FACT, _genre_plays("track_genre")),
        "genre_explicit": _sql([_SONGS], _genre_explicit("songs")),
        "most_popular_track": _sql(_FACT, _top("track_genre", "track_id")),
        "most_popular_track_daily": _sql(_FACT, _top("listen_date, track_genre", "track_id")),
        "genre_kpi": _sql(_FACT, _genre_kpi("songs")),
        "genre_kpi_dirty": _sql(_FACT_DIRTY, _genre_kpi("clean_songs")),
        "genre_kpi_raw_songs": _sql(_FACT_DIRTY, _genre_kpi("songs_dirty")),
        "daily_genre_kpi": _sql(_FACT, _DAILY_GENRE_KPI),
        "daily_genre_kpi_dirty": _sql(_FACT_DIRTY, _DAILY_GENRE_KPI),
        "hourly_totals": _sql(_FACT, _HOURLY_TOTALS),
        "top_genre_hourly": _sql(_FACT, _top(_HOUR, "track_genre")),
        "top_artist_hourly": _sql(_FACT, _top(_HOUR, "artists")),
        "top_age_group_hourly": _sql(_FACT, _top(_HOUR, "age_group", _AGED)),
        "hourly_kpi": _sql(_FACT, _HOURLY_KPI),
        "hourly_kpi_dirty": _sql(_FACT_DIRTY, _HOURLY_KPI),
        "track_summary": _sql(_FACT, _track_summary("songs")),
        "track_summary_dirty": _sql(_FACT_DIRTY, _track_summary("clean_songs")),
        "track_summary_raw_songs": _sql(_FACT_DIRTY, _track_summary("songs_dirty")),
        "track_popularity": _sql(
            _FACT, _track_summary("songs") + " ORDER BY total_streams DESC, p.track_id"
        ),
        "reconcile_totals": _sql(_FACT, _RECONCILE),
        "reconcile_totals_dirty": _sql(_FACT_DIRTY, _RECONCILE),
        "view_genre_kpi": _sql(_FACT, _genre_kpi("songs")),
        "view_hourly_kpi": _sql(_FACT, _HOURLY_KPI),
        "view_track_summary": _sql(_FACT, _track_summary("songs")),
        "jsonl_round_trip": _sql(
            _INPUT_DIRTY, "SELECT * REPLACE (CAST(id AS INTEGER) AS id) FROM songs_dirty"
        ),
        "csv_round_trip": _sql(
            _INPUT_DIRTY,
            f"SELECT CAST(user_id AS INTEGER) AS user_id, track_id, "
            f"{_text('listen_time')} AS listen_time FROM streams_dirty",
        ),
        "streams_full_cleaned": _sql(
            _FACT,
            "SELECT "
            + ", ".join(
                f"{_text(c)} AS {c}"
                if c in ("listen_time", "created_at")
                else f"CAST({c} AS VARCHAR) AS {c}"
                for c in dict.fromkeys([*_STREAM_COLUMNS, *_USER_COLUMNS, *_SONG_COLUMNS])
            )
            + " FROM fact",
        ),
        "kafka_keys": _sql(
            [_STREAMS],
            f"SELECT CAST(row_number() OVER () - 1 AS VARCHAR) AS key, {_EVENT} FROM streams",
        ),
        "kafka_records": _sql(
            [_STREAMS],
            f"SELECT CAST(event_id AS VARCHAR) AS key, {_EVENT} FROM events_mapped",
        ),
        "kafka_events": _sql(
            [_STREAMS],
            "SELECT CAST(user_id AS INTEGER) AS user_id, track_id, "
            f"{_text('listen_time')} AS listen_time FROM streams",
        ),
        **dict.fromkeys(("land_and_read_day", "landed_day_manifest"), _sql(
            [_STREAMS],
            "SELECT CAST(user_id AS INTEGER) AS user_id, track_id, "
            f"{_text('listen_time')} AS listen_time, "
            + ", ".join(
                f"CAST(extract({p} FROM listen_time) AS INTEGER) AS {p}"
                for p in ("year", "month", "day", "hour")
            )
            + " FROM streams WHERE CAST(listen_time AS DATE) = DATE '2024-01-15'",
        )),
        "landed_hours": _sql(
            [_STREAMS],
            "SELECT "
            + ", ".join(
                f"CAST(extract({p} FROM listen_time) AS INTEGER) AS {p}"
                for p in ("year", "month", "day", "hour")
            )
            + ", count(*) AS events FROM streams GROUP BY ALL",
        ),
        "stored_hourly_kpi": _sql(_FACT_DIRTY, _HOURLY_KPI),
        "audit_missing_users_sliced": _sql(
            _CLEANED, _AUDIT_ROWS + _unmatched("clean_users", "user_id")
        ),
        "audit_missing_songs_sliced": _sql(
            _CLEANED, _AUDIT_ROWS + _unmatched("clean_songs", "track_id")
        ),
        "jsonl_extra_columns": _sql(
            [_STREAMS],
            "SELECT DISTINCT CAST(user_id AS INTEGER) AS user_id, track_id, "
            f"{_text('listen_time')} AS listen_time, 'd' || (user_id % 7) AS device, "
            "user_id % 11 AS volume FROM streams",
        ),
        "jsonl_bare_nan": _sql(
            [_USERS],
            "SELECT CAST(user_id AS INTEGER) AS user_id, "
            "CASE WHEN user_id % 5 = 0 THEN 'NaN, it is' ELSE user_name END AS user_name, "
            "CASE WHEN user_id % 9 = 0 THEN NULL ELSE user_age END AS user_age, "
            "CASE WHEN user_id % 7 = 0 THEN NULL ELSE 'here' END AS user_country FROM users",
        ),
        "json_array_round_trip": _sql(
            _INPUT_DIRTY, "SELECT * REPLACE (CAST(id AS INTEGER) AS id) FROM songs_dirty"
        ),
        "any_missing": _sql(
            _CLEANED,
            " UNION ALL ".join(
                [
                    _any_missing("streams_dirty", _STREAM_COLUMNS).replace(
                        "'streams_dirty'", "'streams'"
                    ),
                    _any_missing("users_dirty", _USER_COLUMNS).replace("'users_dirty'", "'users'"),
                    _any_missing("songs_dirty", _SONG_COLUMNS).replace("'songs_dirty'", "'songs'"),
                    _any_missing("clean_streams", _STREAM_COLUMNS),
                    _any_missing("clean_users", _USER_COLUMNS),
                ]
            ),
        ),
        "column_types": _sql(
            [_USERS, _SONGS],
            " UNION ALL ".join(
                _column_types("songs", _SONG_TYPES, _SONG_COLUMNS)
                + _column_types("users", _USER_TYPES, _USER_COLUMNS)
            ),
        ),
        "clean_songs_missing_id": _sql([_SONGS], "SELECT * FROM songs"),
        "reconcile_totals_empty": _sql(
            [*_FACT[:-1], _FACT[-1].replace("fact AS", "all_plays AS"),
             "\nfact AS (SELECT * FROM all_plays WHERE user_id IS NULL)"],
            _RECONCILE,
        ),
        "stored_fact_two_days": _sql(
            _FACT_DIRTY,
            f"SELECT user_id, track_id, {_text('listen_time')} AS listen_time, user_name, "
            "track_name, track_genre FROM fact",
        ),
        "stored_view_genre_kpi": _sql(_FACT_DIRTY, _genre_kpi("clean_songs")),
        "stored_view_hourly_kpi": _sql(
            _FACT_DIRTY,
            f"SELECT * REPLACE (CAST(listen_date AS VARCHAR) AS listen_date) FROM ({_HOURLY_KPI})",
        ),
        "stored_view_track_summary": _sql(_FACT_DIRTY, _track_summary("clean_songs")),
        "stored_daily_genre_kpi": _sql(
            _FACT_DIRTY,
            "SELECT * REPLACE (CAST(listen_date AS VARCHAR) AS listen_date) "
            f"FROM ({_DAILY_GENRE_KPI})",
        ),
        "listeners_bitmap_genre": _sql(
            _FACT_DIRTY,
            "SELECT track_genre, count(DISTINCT user_id) AS unique_listeners FROM fact GROUP BY ALL",
        ),
        "listeners_bitmap_hourly": _sql(
            _FACT_DIRTY,
            "SELECT CAST(listen_date AS VARCHAR) AS listen_date, listen_hour, "
            "count(DISTINCT user_id) AS unique_listeners FROM fact GROUP BY ALL",
        ),
        "partial_genre_kpi": _sql(_FACT_DIRTY, _genre_kpi("clean_songs")),
        "partial_hourly_kpi": _sql(
            _FACT_DIRTY,
            f"SELECT * REPLACE (CAST(listen_date AS VARCHAR) AS listen_date) FROM ({_HOURLY_KPI})",
        ),
        "partial_daily_genre_kpi": _sql(
            _FACT_DIRTY,
            "SELECT * REPLACE (CAST(listen_date AS VARCHAR) AS listen_date) "
            f"FROM ({_DAILY_GENRE_KPI})",
        ),
        "approx_listeners": _sql(
            _FACT_DIRTY,
            "SELECT listen_hour, count(DISTINCT user_id) AS unique_listeners, "
            "TRUE AS within_error, TRUE AS same_from_one_part FROM fact GROUP BY listen_hour",
        ),
        "rerun_audit": _sql(
            _CLEANED,
            "SELECT CAST(user_id AS INTEGER) AS user_id, track_id, "
            f"{_text('listen_time')} AS listen_time, 'missing_songs' AS audit"
            + _unmatched("clean_songs", "track_id")
            + " AND EXISTS (SELECT 1 FROM clean_users x WHERE x.user_id = s.user_id)",
        ),
    }
