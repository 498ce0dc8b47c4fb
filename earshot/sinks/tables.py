"""Parquet tables in the session's catalog."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.schemas import STREAM_KEY

_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"

# Rows of its first load that a bucket of a new fact should hold, and the most buckets.
ROWS_PER_BUCKET = 1_000_000
MOST_BUCKETS = 512


def write_table(df: DataFrame, table: str, path: str | None = None) -> None:
    """Replace a table, a dimension for instance. ``path`` keeps its files outside the
    warehouse folder."""
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def _create(
    df: DataFrame, table: str, partitions: list[str], path: str | None, clustered: str = ""
) -> None:
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in partitions
    )
    kinds = {"load_date": "DATE", "listen_date": "DATE"}
    df.sparkSession.sql(
        f"CREATE TABLE {table} ({columns}, {', '.join(f'{p} {kinds[p]}' for p in partitions)}) "
        f"USING parquet PARTITIONED BY ({', '.join(partitions)}) {clustered}"
        + (f" LOCATION '{path}'" if path else "")
    )


class _Static:
    """Statically overwritten partitions while any table is written, several side by side."""

    lock, writing, before = Lock(), 0, ""

    @classmethod
    @contextmanager
    def overwrite(cls, spark: SparkSession) -> Iterator[None]:
        with cls.lock:
            if not cls.writing:
                cls.before = spark.conf.get(_OVERWRITE_MODE)
                spark.conf.set(_OVERWRITE_MODE, "static")
            cls.writing += 1
        try:
            yield
        finally:
            with cls.lock:
                cls.writing -= 1
                if not cls.writing:
                    spark.conf.set(_OVERWRITE_MODE, cls.before)


def _replace(rows: DataFrame, table: str, partition: str) -> None:
    with _Static.overwrite(rows.sparkSession):
        rows.sparkSession.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION ({partition}) SELECT * FROM {{rows}}",
            rows=rows,
        )


def write_day(
    df: DataFrame, table: str, load_date: dt.date | str, path: str | None = None
) -> None:
    """Replace what one load day brought to a table partitioned by load day, and nothing else."""
    if not df.sparkSession.catalog.tableExists(table):
        _create(df, table, ["load_date"], path)
    day = dt.date.fromisoformat(str(load_date))
    _replace(df, table, f"load_date = DATE'{day}'")


def buckets_of(spark: SparkSession, table: str) -> int:
    """The buckets of a stored table, none if 0."""
    about = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Num Buckets'").collect()
    return int(about[0]["data_type"]) if about else 0


def _bucket(buckets: int) -> Column:
    return F.pmod(F.hash(*STREAM_KEY), F.lit(buckets))


def write_fact(
    fact: DataFrame,
    table: str,
    load_date: dt.date | str,
    path: str | None = None,
    rebalance: bool = False,
    rows: int = 0,
    dates: int = 1,
) -> None:
    """Replace what one load day brought to a fact table, and nothing else.

    The table is partitioned by load day, then listening date. A load day can bring events of
    any listening date (late ones, and missing times filled with 9999-12-31), so replacing
    listening dates would lose the events other load days brought to them. Columns the table
    doesn't have yet are added; those it has and the fact doesn't become null.

    Inside, the table is bucketed by the events' whole key, so looking for events already stored
    moves the new ones only, and a user or track with a third of all events is spread over all
    buckets. A new table gets buckets for ``rows``, those of its first load or what is expected
    of the largest; they stay. A fact
    without the key's columns, or a table that has no buckets, is written without.

    Every listening date has a file for each bucket. Where ``rows`` are spread over many
    ``dates``, a long history, there are buckets for the rows of one date only, so that files
    grow with the rows and not with dates times rows. If those fit one bucket there are none:
    one would be read by a single task.

    Each task writes one bucket, a file for each listening date. One load day has few of these. A
    load of a long history has many, and large buckets: ``rebalance`` gathers by date and bucket
    in evenly sized tasks, where adaptive execution splits what is too big for one.
    """
    spark = fact.sparkSession
    day = dt.date.fromisoformat(str(load_date))
    if not spark.catalog.tableExists(table):
        buckets = min(MOST_BUCKETS, max(1, -(-rows // (ROWS_PER_BUCKET * dates))))
        clustered = f"CLUSTERED BY ({', '.join(STREAM_KEY)}) INTO {buckets} BUCKETS"
        keyed = set(STREAM_KEY) <= set(fact.columns) and (dates == 1 or buckets > 1)
        _create(fact, table, ["load_date", "listen_date"], path, clustered if keyed else "")
    buckets = buckets_of(spark, table)
    stored = spark.table(table).schema
    new = [f for f in fact.schema.fields if f.name not in stored.names]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
        stored = spark.table(table).schema
    written = fact.select(
        *[
            F.col(f"`{f.name}`") if f.name in fact.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in stored.fields
            if f.name not in ("load_date", "listen_date")
        ],
        "listen_date",
    )
    if rebalance:
        by = ["listen_date", *(["_bucket"] if buckets else [])]
        if buckets:
            written = written.withColumn("_bucket", _bucket(buckets))
        written = written.hint("rebalance", *by).drop("_bucket")
    elif buckets:
        written = written.repartition(buckets, *STREAM_KEY)
    _replace(written, table, f"load_date = DATE'{day}', listen_date")
