"""The most played label of each group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_one(counts: DataFrame, keys: Sequence[str], plays: str, label: Column) -> DataFrame:
    """Keep the row with the most ``plays`` per key; ties go to the lowest label.

    ``counts`` is already grouped, one row per key and label. The filter on the row number
    lets each task keep its own best row per key before the shuffle.
    """
    order = [F.col(plays).desc(), label.asc_nulls_last()]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return counts.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")
