"""Bringing songs, users and events to where the daily job reads them.

Songs and users go from CSV into a database and from there to JSON lines; events go from CSV
to a topic and from there to hour folders. Each step is a job of its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from earshot import schemas
from earshot.operators.ordinal import with_ordinal
from earshot.session import configure
from earshot.sinks.files import write_jsonl
from earshot.sinks.jdbc import write_jdbc
from earshot.sinks.kafka import to_kafka_records, write_kafka
from earshot.sources.files import read_csv_table
from earshot.sources.jdbc import read_jdbc
from earshot.sources.kafka import read_kafka_records
from earshot.streaming.landing import land_records

# Song columns longer than the database's 255 characters.
LONG_TEXT = ("artists", "album_name", "track_name")


def database_frames(
    spark: SparkSession, songs_csv: str, users_csv: str
) -> dict[str, DataFrame]:
    """Songs and users as the database holds them: times as text, flags as booleans."""
    configure(spark)
    songs = read_csv_table(spark, songs_csv, schemas.SONGS)
    users = read_csv_table(spark, users_csv, schemas.with_text_times(schemas.USERS))
    flags = {c: F.col(c).cast("boolean") for c in schemas.FLAGS}
    return {"songs": songs.withColumns(flags), "users": users}


def load_database(
    spark: SparkSession, songs_csv: str, users_csv: str, url: str, options: Mapping[str, str]
) -> None:
    """Replace the tables ``songs`` and ``users``."""
    for table, df in database_frames(spark, songs_csv, users_csv).items():
        write_jdbc(df, url, table, options, LONG_TEXT if table == "songs" else ())


def export_database(
    spark: SparkSession, url: str, options: Mapping[str, str], songs_path: str, users_path: str
) -> None:
    """Write both tables as JSON lines, reading each in parallel over its numeric key."""
    configure(spark)
    write_jsonl(read_jdbc(spark, url, "songs", options, "id"), songs_path)
    write_jsonl(read_jdbc(spark, url, "users", options, "user_id"), users_path)


def stream_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Events of all files as records: the ordinal over all files, and the event as JSON."""
    configure(spark)
    events = read_csv_table(spark, paths, schemas.with_text_times(schemas.STREAMS))
    return to_kafka_records(with_ordinal(events), "ordinal")


def publish_streams(
    spark: SparkSession,
    paths: Sequence[str],
    servers: str,
    topic: str,
    options: Mapping[str, str] | None = None,
) -> None:
    write_kafka(stream_records(spark, paths), servers, topic, options)


def land_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    root: str,
    checkpoint: str,
    options: Mapping[str, str] | None = None,
    hour_of: Column | None = None,
    once: bool = True,
    files_per_hour: int | None = None,
) -> StreamingQuery:
    """Land a topic by hour: that of ``hour_of``, by default the record's own timestamp. A
    backlog of many hours should set ``files_per_hour``."""
    configure(spark)
    records = read_kafka_records(spark, servers, topic, options)
    hour = F.col("timestamp") if hour_of is None else hour_of
    return land_records(records, root, checkpoint, hour, once, files_per_hour)
