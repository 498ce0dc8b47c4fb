"""The fact table and its slim form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.schemas import SLIM_FACT_COLUMNS


def fact_streams(enriched: DataFrame) -> DataFrame:
    """Joined events with the date and hour of listening."""
    return enriched.withColumns(
        {
            "listen_date": F.to_date("listen_time"),
            "listen_hour": F.hour("listen_time"),
        }
    )


def fact_streams_slim(fact: DataFrame) -> DataFrame:
    return fact.select(*SLIM_FACT_COLUMNS)
