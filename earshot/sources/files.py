"""CSV, JSON lines and hour-partitioned landing files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.operators.cleaning import apply_schema
from earshot.schemas import HOUR_PARTITIONS, text_form
from earshot.session import exists
from earshot.sources.records import further_columns, parse_records
from earshot.streaming.landing import MANIFEST

# The texts that a data-frame CSV reader takes for a missing field.
MISSING_MARKERS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_csv_table(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    quoted_newlines: bool = False,
) -> DataFrame:
    """CSV with a header, typed to ``schema``. Several paths are read as one table.

    A header that differs from the schema, a malformed line or a value of the wrong type
    fails the read. ``quoted_newlines`` allows line breaks inside quotes; such files cannot
    be split, so each is read by one task.
    """
    text = (
        spark.read.schema(text_form(schema))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("escape", '"')
        .option("multiLine", quoted_newlines)
        .csv(paths if isinstance(paths, str) else list(paths))
    )
    present = [
        F.when(~F.col(f"`{c}`").isin(MISSING_MARKERS), F.col(f"`{c}`")).alias(c)
        for c in text.columns
    ]
    return apply_schema(text.select(present), schema)


def read_jsonl(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    multiline: bool = False,
    further: T.StructType | bool | None = None,
) -> DataFrame:
    """One JSON object per line, typed to ``schema``; blank lines are skipped, and a bare NaN is
    missing.

    A malformed line fails the read. ``multiline`` reads files that hold one JSON array or
    object over several lines; such files cannot be split. ``further`` names columns to read
    beyond the schema, or is true to look for them in one more pass.
    """
    records = text_records(spark, paths, multiline)
    if further is True:
        further = further_columns(records, schema)
    return parse_records(records, schema, further=further or None, array=multiline)


def text_records(
    spark: SparkSession, paths: str | Sequence[str], wholetext: bool = False
) -> DataFrame:
    """The lines, or whole texts, of files as ``value``."""
    return spark.read.text(paths if isinstance(paths, str) else list(paths), wholetext=wholetext)


def hour_records(
    spark: SparkSession, root: str, day: dt.date | str | None, listed_by: str = "folder"
) -> DataFrame:
    """The lines of one landing day, or of the whole history, as ``value`` with their hours.

    ``listed_by`` says what tells the day's files: its ``folder``; the commit ``log`` of a root
    written by ``land_records``, which leaves out files of unfinished attempts but is opened whole,
    so its cost grows with the history; or the ``manifest`` of one written by ``land_batches``,
    which leaves them out too and is opened for that day alone.
    """
    if listed_by not in ("folder", "log", "manifest"):
        raise ValueError(f"unknown listing: {listed_by}")
    reader = spark.read.option("basePath", root)
    day = day if day is None else dt.date.fromisoformat(str(day))
    if listed_by == "manifest":
        lists = f"{root}/{MANIFEST}" + (f"/date={day}" if day else "")
        if not exists(spark, lists):
            none = T.StructType([T.StructField("value", T.StringType()), *HOUR_PARTITIONS.fields])
            return spark.createDataFrame([], none)
        # One row for each file that is read, as the reader itself holds.
        files = spark.read.schema("file string").json(lists).collect()
        return reader.text([f"{root}/{r['file']}" for r in files])
    if day is None:
        return reader.text(root)
    folder = f"{root}/year={day:%Y}/month={day:%m}/day={day:%d}"
    return reader.text(root if listed_by == "log" else folder).where(
        (F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day") == day.day)
    )


def read_hour_partitions(
    spark: SparkSession,
    root: str,
    day: dt.date | str | None,
    schema: T.StructType,
    keep_hours: bool = False,
    listed_by: str = "folder",
    further: T.StructType | bool | None = None,
) -> DataFrame:
    """All hours of one landing day under ``root``/year=/month=/day=/hour=, or with no ``day``
    the whole history. ``listed_by`` is as in ``hour_records``, ``further`` as in ``read_jsonl``.
    """
    records = hour_records(spark, root, day, listed_by)
    if further is True:
        further = further_columns(records, schema)
    return parse_records(
        records, schema, HOUR_PARTITIONS.names if keep_hours else (), further or None
    )
