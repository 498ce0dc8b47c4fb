"""Dimension tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions import (
    age_group,
    duration_min_sec,
    duration_s,
    is_new_weekly,
    tempo_level,
)
from earshot.functions.columns import WEEK_REFERENCE


def dim_users(users: DataFrame, reference: dt.date | str = WEEK_REFERENCE) -> DataFrame:
    """Users with age group and the new-this-week flag."""
    return users.withColumns(
        {
            "age_group": age_group(F.col("user_age")),
            "is_new_weekly": is_new_weekly(F.col("created_at"), reference),
        }
    )


def dim_songs(songs: DataFrame) -> DataFrame:
    """Songs without their row id, with duration in seconds and as text, and tempo level."""
    return songs.drop("id").withColumns(
        {
            "duration_s": duration_s(F.col("duration_ms")),
            "duration_min_sec": duration_min_sec(F.col("duration_ms")),
            "tempo_level": tempo_level(F.col("tempo")),
        }
    )
