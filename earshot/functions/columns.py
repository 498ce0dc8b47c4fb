"""Scalar expressions over columns. All of them stay inside code generation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
NO_BUCKET = "nan"
UNKNOWN_AGE = "Unknown"
WEEK_REFERENCE = dt.date(2024, 6, 25)


def age_group(age: Column, other: str = NO_BUCKET) -> Column:
    """'10-19' ... '90-99', or ``other`` below 10, from 100 on and for a missing age."""
    low = F.floor(age / 10) * 10
    label = F.concat_ws("-", low.cast("string"), (low + 9).cast("string"))
    return F.when((age >= 10) & (age < 100), label).otherwise(F.lit(other))


def tempo_level(tempo: Column) -> Column:
    """Slow to 90, medium to 120, fast above; 'nan' at or below zero and for a missing tempo.

    Spark orders NaN above every number, so it is ruled out first.
    """
    return (
        F.when(tempo.isNull() | F.isnan(tempo) | (tempo <= 0), NO_BUCKET)
        .when(tempo <= 90, "slow")
        .when(tempo <= 120, "medium")
        .otherwise("fast")
    )


def is_new_weekly(created_at: Column, reference: dt.date | str = WEEK_REFERENCE) -> Column:
    """Created on the reference date or one of the six days before it; false when unknown."""
    last = F.lit(reference).cast("date")
    return F.coalesce(F.to_date(created_at).between(F.date_sub(last, 6), last), F.lit(False))


def duration_s(duration_ms: Column) -> Column:
    return duration_ms / 1000


def duration_min_sec(duration_ms: Column) -> Column:
    """Minutes and two-digit seconds, '3:50'; null stays null."""
    minutes = F.floor(duration_ms / 60000)
    seconds = F.floor(F.pmod(duration_ms, F.lit(60000)) / 1000)
    return F.when(duration_ms.isNotNull(), F.format_string("%d:%02d", minutes, seconds))


def flag_to_int(flag: Column) -> Column:
    """1 or 0 from a boolean, a 0/1 number or their text; any other text is an error."""
    text = F.lower(F.trim(flag.cast("string")))
    return (
        F.when(text.isin("1", "1.0", "true"), 1)
        .when(text.isin("0", "0.0", "false"), 0)
        .when(text.isNull(), F.lit(None).cast("int"))
        .otherwise(F.raise_error(F.concat(F.lit("not a flag: "), text)).cast("int"))
    )
