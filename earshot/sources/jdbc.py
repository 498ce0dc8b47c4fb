"""Database tables, read in parallel."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    options: Mapping[str, str],
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 64,
) -> DataFrame:
    """A whole table. With ``partition_column``, a numeric key, each task reads one range of
    it; without ``bounds`` the database is asked for the lowest and highest value first.

    ``options`` carries driver, user and password; none is kept here.
    """
    source = spark.read.format("jdbc").options(**options).option("url", url)
    whole = source.option("dbtable", table)
    if partition_column is None:
        return whole.load()
    if bounds is None:
        ends = f"SELECT min({partition_column}) AS low, max({partition_column}) AS high FROM {table}"
        edge = (
            spark.read.format("jdbc").options(**options).option("url", url).option("query", ends)
        ).load().first()
        bounds = (edge[0] or 0, edge[1] or 0)
    return (
        whole.option("partitionColumn", partition_column)
        .option("lowerBound", bounds[0])
        .option("upperBound", bounds[1] + 1)
        .option("numPartitions", partitions)
        .load()
    )
