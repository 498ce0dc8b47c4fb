"""Numbering the rows of a table read from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.session import fresh_folder, stage

# Files whose row counts are summed by one task; the totals of such blocks alone reach the driver.
FILES_PER_BLOCK = 10_000

# First numbers of more files than this are joined by a shuffle.
_BROADCAST_FILES = 100_000


def _is_scan(df: DataFrame) -> bool:
    """Whether a frame is files of a format that numbers its rows, with nothing above them that
    leaves out, repeats or moves rows."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "SubqueryAlias"):
        plan = plan.children().head()
    if not plan.getClass().getName().endswith(".LogicalRelation"):
        return False
    source = plan.relation()
    return source.getClass().getName().endswith(".HadoopFsRelation") and (
        source.fileFormat().toString() == "Parquet"
    )


def with_ordinal(df: DataFrame, name: str = "ordinal") -> DataFrame:
    """Number the rows 0, 1, 2, ... without moving them.

    A row's place in its Parquet file is the reader's, whatever splits the file is read in, so
    the pass that counts and the one that numbers need not agree on splits, and a retried task
    numbers alike. One pass counts the rows of each file. Where a file starts is the total of the
    blocks of files before its own and a running sum in its block, in the order of their paths
    (up to ten thousand files are one block; more are dealt to blocks by a hash of the path).

    Frames that are not plain columns over Parquet files are staged first.
    """
    if not _is_scan(df):
        df = stage(df, fresh_folder(df.sparkSession, "to-number"))
    files = len(df.inputFiles())
    blocks = max(1, -(-files // FILES_PER_BLOCK))
    block = F.pmod(F.xxhash64("_file"), F.lit(blocks)).cast("int")
    placed = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_place"),
    )
    counts = placed.groupBy("_file").agg(F.count("*").alias("_count")).withColumn("_block", block)
    totals = dict(map(tuple, counts.groupBy("_block").agg(F.sum("_count")).collect()))
    first = [0]
    for n in range(blocks):
        first.append(first[-1] + totals.get(n, 0))
    before = F.get(F.array(*[F.lit(n).cast("long") for n in first]), F.col("_block"))
    earlier = (
        Window.partitionBy("_block").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = counts.select(
        "_file", (before + F.coalesce(F.sum("_count").over(earlier), F.lit(0))).alias("_start")
    )
    if files <= _BROADCAST_FILES:
        starts = F.broadcast(starts)
    return (
        placed.join(starts, "_file")
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_file", "_place", "_start")
    )
