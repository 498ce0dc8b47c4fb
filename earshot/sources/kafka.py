"""Records and events from a Kafka topic."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from earshot.sources.records import parse_records


def read_kafka_records(
    spark: SparkSession, servers: str, topic: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """A stream of the topic's records. ``options`` carries security, offset and rate
    settings; for a long backlog, set ``maxOffsetsPerTrigger``."""
    return (
        spark.readStream.format("kafka")
        .options(**(options or {}))
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .load()
    )


def read_kafka_events(
    spark: SparkSession,
    servers: str,
    topic: str,
    schema: T.StructType,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A stream of the topic's events, typed to ``schema``."""
    return parse_records(read_kafka_records(spark, servers, topic, options), schema)
