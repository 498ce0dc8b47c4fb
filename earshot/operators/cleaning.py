"""Typing, filling and deduplicating."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.functions import flag_to_int
from earshot.schemas import FLAGS

# Fixed values.
MISSING_TEXT = "Unknown"
MISSING_TIME = dt.datetime(9999, 12, 31)

_FRACTIONS = (T.DoubleType, T.FloatType)
_TIMES = (T.TimestampType, T.TimestampNTZType)


def parse_timestamp(value: Column, layout: str | None = None, strict: bool = True) -> Column:
    """Text to timestamp. Strict: text that is no timestamp fails the job, whatever the
    session's ANSI setting; otherwise it becomes null."""
    parsed = F.try_to_timestamp(value, F.lit(layout)) if layout else F.try_to_timestamp(value)
    if not strict:
        return parsed
    refused = F.raise_error(F.concat(F.lit("not a timestamp: "), value)).cast("timestamp")
    return F.when(value.isNotNull() & parsed.isNull(), refused).otherwise(parsed)


def parse_timestamps(
    df: DataFrame, columns: Sequence[str], layout: str | None = None, strict: bool = True
) -> DataFrame:
    """Parse the text columns among ``columns``; typed ones stay as they are."""
    text = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    return df.withColumns({c: parse_timestamp(F.col(c), layout, strict) for c in text})


def apply_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast loosely read columns to ``schema``. Further columns pass through."""
    have = {f.name: f.dataType for f in df.schema.fields}

    def typed(field: T.StructField) -> Column:
        value, source, target = F.col(f"`{field.name}`"), have[field.name], field.dataType
        if field.name in FLAGS:
            return flag_to_int(value)
        if isinstance(source, T.StringType) and isinstance(target, T.TimestampType):
            return parse_timestamp(value)
        if isinstance(source, T.StringType) and isinstance(target, T.IntegerType):
            value, source = value.cast("double"), T.DoubleType()
        if isinstance(source, _FRACTIONS) and isinstance(target, T.IntegerType):
            value = F.when(~F.isnan(value), value)
            refused = F.raise_error(
                F.concat(F.lit(f"not a whole number in {field.name}: "), value.cast("string"))
            )
            value = F.when(value == F.floor(value), value).when(
                value.isNotNull(), refused.cast("double")
            )
        return value.cast(target)

    wanted = {f.name: typed(f).alias(f.name) for f in schema.fields if f.name in have}
    return df.select([wanted.get(name, F.col(f"`{name}`")) for name in have])


def fill_missing(df: DataFrame) -> DataFrame:
    """Text to 'Unknown', times to 9999-12-31, numbers (NaN too) to 0, flags to false."""

    def filled(field: T.StructField) -> Column:
        value, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.StringType):
            return F.coalesce(value, F.lit(MISSING_TEXT))
        if isinstance(kind, (*_TIMES, T.DateType)):
            return F.coalesce(value, F.lit(str(MISSING_TIME)).cast(kind))
        if isinstance(kind, _FRACTIONS):
            return F.coalesce(F.nanvl(value, F.lit(0).cast(kind)), F.lit(0).cast(kind))
        if isinstance(kind, T.NumericType):
            return F.coalesce(value, F.lit(0).cast(kind))
        if isinstance(kind, T.BooleanType):
            return F.coalesce(value, F.lit(False))
        return value

    return df.select([filled(f).alias(f.name) for f in df.schema.fields])


def fill_and_keep_first(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """Filled, one row per filled key. The first is chosen by what the order columns held before
    they were filled, so a row whose order is missing comes last."""
    held = {f"_{c}_unfilled": F.struct(F.col(f"`{c}`").alias("v")) for c in order_by}
    filled = fill_missing(df.withColumns(held))
    names = {f"_{c}_before": F.col(f"`_{c}_unfilled`")["v"] for c in order_by}
    kept = drop_duplicates_first(
        filled.withColumns(names).drop(*held), keys, list(names)
    )
    return kept.drop(*names)


def drop_duplicates_first(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the first in ``order_by``, missing values last.

    The remaining columns break ties, so a retried task picks the same row again. Keys that
    cover the whole row need no order and combine on the map side; otherwise the plan keeps
    one row per key and map partition (WindowGroupLimit) before the shuffle, so a key with a
    third of all rows sends only one row per map task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    order = [F.col(f"`{c}`").asc_nulls_last() for c in (*order_by, *rest)]
    if not order:
        return df.dropDuplicates(list(keys))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")
