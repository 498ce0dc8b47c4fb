"""Songs, users and events derived from the given tables (FIXTURES.md, section 2)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.plans import enrich, facts
from earshot.session import fresh_folder, stage


class Inputs:
    """The mapped frames of one data folder. All lazy; sizes are measured once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return map_events(self.table("events"))

    @cached_property
    def streams(self) -> DataFrame:
        return self.events.drop("event_id")

    @cached_property
    def users(self) -> DataFrame:
        nations = self.table("nation").select("n_nationkey", "n_name")
        customers = self.table("customer")
        return customers.join(
            nations, customers.c_nationkey == nations.n_nationkey, "left"
        ).selectExpr(
            "c_custkey + 1 AS user_id",
            "c_name AS user_name",
            "CAST(5 + c_custkey % 100 AS INT) AS user_age",
            "n_name AS user_country",
            "TIMESTAMP_NTZ'2024-06-10 00:00:00' + make_dt_interval(CAST(c_custkey % 30 AS INT))"
            " AS created_at",
        )

    @cached_property
    def songs(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey AS id",
            "concat('T', p_partkey) AS track_id",
            "p_brand AS artists",
            "'album' AS album_name",
            "p_name AS track_name",
            "p_size AS popularity",
            "CAST(floor(p_retailprice * 250) AS INT) AS duration_ms",
            "CAST(p_partkey % 5 = 0 AS INT) AS explicit",
            "CAST(if(p_partkey % 41 = 0, 0, p_size * 4) AS DOUBLE) AS tempo",
            "p_type AS track_genre",
        )

    @cached_property
    def streams_dirty(self) -> DataFrame:
        """Null keys and times, unknown users and tracks, exact duplicates. One scan: the
        duplicates are the same row emitted twice."""
        return self.events.selectExpr(
            "CASE WHEN event_id % 17 = 0 THEN NULL"
            " WHEN event_id % 13 = 0 THEN user_id + 1000000 ELSE user_id END AS user_id",
            "CASE WHEN event_id % 19 = 0 THEN NULL"
            " WHEN event_id % 11 = 0 THEN concat('X', track_id) ELSE track_id END AS track_id",
            "CASE WHEN event_id % 23 = 0 THEN NULL ELSE listen_time END AS listen_time",
            "explode(if(event_id % 10 = 0, array(1, 2), array(1))) AS copy",
        ).drop("copy")

    @cached_property
    def users_dirty(self) -> DataFrame:
        """Missing countries and ages, users signed up twice (the earlier one must win)."""
        return self.users.selectExpr(
            "user_id",
            "user_name",
            "if(user_id % 9 = 0, NULL, user_age) AS user_age",
            "if(user_id % 7 = 0, NULL, user_country) AS user_country",
            "created_at",
            "explode(if(user_id % 40 = 0, array(0, 1), array(0))) AS copy",
        ).selectExpr(
            "user_id",
            "if(copy = 1, concat(user_name, ' again'), user_name) AS user_name",
            "user_age",
            "user_country",
            "created_at + make_dt_interval(copy) AS created_at",
        )

    @cached_property
    def songs_dirty(self) -> DataFrame:
        """Null genres, repeated tracks (the lowest id must win)."""
        repeated = self.songs.withColumn(
            "copy", F.explode(F.expr("if(id % 50 = 0, array(0, 1), array(0))"))
        )
        return repeated.select(
            (F.col("id") + F.col("copy") * 1000000).alias("id"),
            *[c for c in self.songs.columns if c not in ("id", "popularity", "track_genre")],
            (F.col("popularity") + F.col("copy")).alias("popularity"),
            F.expr("if(copy = 0 AND id % 7 = 0, NULL, track_genre)").alias("track_genre"),
        ).select(self.songs.columns)

    @cached_property
    def event_rows(self) -> int:
        return self.table("events").count()

    @cached_property
    def sizes(self) -> enrich.Sizes:
        """Each lookup is measured once per folder."""
        return enrich.Sizes()

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich.enrich_streams(self.streams, self.users, self.songs, sizes=self.sizes)

    @cached_property
    def clean_streams(self) -> DataFrame:
        return enrich.clean_streams(self.streams_dirty)

    @cached_property
    def clean_users(self) -> DataFrame:
        return enrich.clean_users(self.users_dirty)

    @cached_property
    def clean_songs(self) -> DataFrame:
        return enrich.clean_songs(self.songs_dirty)

    @cached_property
    def enriched_dirty(self) -> DataFrame:
        return enrich.enrich_streams(
            self.clean_streams, self.clean_users, self.clean_songs, sizes=self.sizes
        )

    @cached_property
    def fact(self) -> DataFrame:
        """The stored fact of the clean mapping."""
        return stage(facts.fact_streams(self.enriched), fresh_folder(self.spark, "fact"))

    @cached_property
    def fact_dirty(self) -> DataFrame:
        """The stored fact of the cleaned dirty events."""
        return stage(facts.fact_streams(self.enriched_dirty), fresh_folder(self.spark, "fact"))


# The number in {"k": 76}. A pattern finds it several times faster than a JSON parser; props of
# any other shape go to the parser.
_TRACK_NUMBER = r"""coalesce(
  nullif(regexp_extract(props, '^\\{"k": *([0-9]+)\\}$', 1), ''), get_json_object(props, '$.k'))"""


def map_events(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        (F.col("user_id") + 1).alias("user_id"),
        F.concat(F.lit("T"), F.expr(_TRACK_NUMBER)).alias("track_id"),
        F.col("ts").alias("listen_time"),
    )


def times_as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Times as text for comparing results: the fill date lies beyond what nanosecond
    clocks, which result frames on the driver use, can hold."""
    layout = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return df.withColumns({c: F.date_format(c, layout) for c in columns})
