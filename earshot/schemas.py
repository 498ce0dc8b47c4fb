"""Fixed schemas. No job infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

_INT, _DOUBLE, _TEXT, _TIME = T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# Column names and types of the tables.
SONGS = _struct(
    ("id", _INT),
    ("track_id", _TEXT),
    ("artists", _TEXT),
    ("album_name", _TEXT),
    ("track_name", _TEXT),
    ("popularity", _INT),
    ("duration_ms", _INT),
    ("explicit", _INT),
    ("danceability", _DOUBLE),
    ("energy", _DOUBLE),
    ("key", _INT),
    ("loudness", _DOUBLE),
    ("mode", _INT),
    ("speechiness", _DOUBLE),
    ("acousticness", _DOUBLE),
    ("instrumentalness", _DOUBLE),
    ("liveness", _DOUBLE),
    ("valence", _DOUBLE),
    ("tempo", _DOUBLE),
    ("time_signature", _INT),
    ("track_genre", _TEXT),
)

USERS = _struct(
    ("user_id", _INT),
    ("user_name", _TEXT),
    ("user_age", _INT),
    ("user_country", _TEXT),
    ("created_at", _TIME),
)

STREAMS = _struct(("user_id", _INT), ("track_id", _TEXT), ("listen_time", _TIME))

# 0/1 columns that also arrive as true/false.
FLAGS = ("explicit",)

USER_KEY = ["user_id"]
SONG_KEY = ["track_id"]
STREAM_KEY = ["user_id", "track_id", "listen_time"]

# Which of several rows with one key counts as the first.
USER_ORDER = ["created_at", "user_name"]
SONG_ORDER = ["id"]

# The columns of the slim fact.
SLIM_FACT_COLUMNS = [
    "user_id",
    "track_id",
    "listen_time",
    "listen_date",
    "listen_hour",
    "artists",
    "track_name",
    "track_genre",
]

HOUR_PARTITIONS = _struct(("year", _INT), ("month", _INT), ("day", _INT), ("hour", _INT))


def json_form(schema: T.StructType) -> T.StructType:
    """The schema to read JSON records with, before ``apply_schema``.

    Whole numbers may be written 12 or 12.0, flags 1 or true, and times are text.
    """

    def loosen(field: T.StructField) -> T.DataType:
        if field.name in FLAGS or isinstance(field.dataType, T.TimestampType):
            return _TEXT
        if isinstance(field.dataType, T.IntegerType):
            return _DOUBLE
        return field.dataType

    return T.StructType([T.StructField(f.name, loosen(f), True) for f in schema.fields])


def with_text_times(schema: T.StructType) -> T.StructType:
    """The schema of the same table before its times are parsed."""
    return T.StructType(
        [
            T.StructField(f.name, _TEXT if isinstance(f.dataType, T.TimestampType) else f.dataType)
            for f in schema.fields
        ]
    )


def text_form(schema: T.StructType) -> T.StructType:
    """The schema to read CSV fields with: text, typed later by ``apply_schema``."""
    return T.StructType([T.StructField(f.name, _TEXT, True) for f in schema.fields])
