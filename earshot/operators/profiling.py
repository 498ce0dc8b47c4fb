"""Row counts, missing values, repeated keys and previews."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: table_name, row_count, column_count."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(len(df.columns)).alias("column_count"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def column_types(df: DataFrame) -> list[tuple[str, str]]:
    """Column names with their types, from the schema alone."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def _missing(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        value = F.when(~F.isnan(value), value)
    return F.count_if(value.isNull())


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: column_name, missing (null or NaN). One pass over the data."""
    counts = df.agg(*[_missing(f).alias(f.name) for f in df.schema.fields])
    return counts.unpivot([], [F.col(f"`{c}`") for c in df.columns], "column_name", "missing")


class Counted:
    """Rows and missing values, counted by whatever job reads ``df`` first.

    The job that writes ``df`` itself counts every row once, also where a lost executor's tasks
    run again. Below a shuffle, lost tasks would be counted anew.
    """

    def __init__(self, frame: DataFrame) -> None:
        self._seen, self._names = Observation(), frame.columns
        missing = [_missing(f).alias(f"c{n}") for n, f in enumerate(frame.schema.fields)]
        self.df = frame.observe(self._seen, F.count("*").alias("rows"), *missing)

    @property
    def rows(self) -> int:
        return self._seen.get.get("rows", 0)

    @property
    def missing(self) -> dict[str, int]:
        """By column."""
        return {name: self._seen.get.get(f"c{n}", 0) for n, name in enumerate(self._names)}


def has_missing(df: DataFrame) -> bool:
    """Whether any value is null or NaN. Runs a job."""
    return not null_profile(df).where(F.col("missing") > 0).isEmpty()


def duplicate_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that occur more than once, with their row counts in ``copies``."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def preview(df: DataFrame, rows: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    """The first rows; with ``order_by`` the same ones every time."""
    return (df.orderBy(*order_by) if order_by else df).limit(rows)
