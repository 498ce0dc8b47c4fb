"""Landing a stream of JSON records as hour-partitioned files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from earshot.schemas import HOUR_PARTITIONS
from earshot.session import files_in

_LAYOUTS = dict(zip(HOUR_PARTITIONS.names, ["yyyy", "MM", "dd", "HH"], strict=True))

# Under the landing root: which files each batch landed for each day.
MANIFEST = "_manifest"


def _by_hour(records: DataFrame, hour_of: Column, files_per_hour: int | None) -> DataFrame:
    """One line per record beside the partitions it goes to."""
    hours = [F.date_format(hour_of, layout).alias(name) for name, layout in _LAYOUTS.items()]
    # Line breaks in JSON stand between tokens only; inside strings they are escaped.
    line = F.translate(F.col("value").cast("string"), "\r\n", "  ").alias("value")
    landed = records.select(line, *hours)
    if files_per_hour is None:
        return landed
    sliced = landed.withColumn("_slice", F.pmod(F.spark_partition_id(), F.lit(files_per_hour)))
    return sliced.repartition(*_LAYOUTS, "_slice").drop("_slice")


def _started(writer: DataStreamWriter, checkpoint: str, once: bool) -> StreamingQuery:
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def land_records(
    records: DataFrame,
    root: str,
    checkpoint: str,
    hour_of: Column,
    once: bool = True,
    files_per_hour: int | None = None,
) -> StreamingQuery:
    """Start writing each record's ``value``, one JSON object per line as it arrived, under
    ``root``/year=/month=/day=/hour= by the hour of the timestamp ``hour_of``.

    ``checkpoint`` must be on storage all nodes share: after a lost executor or driver the
    query goes on from it, and the sink's commit log names each file once. ``once`` lands what
    has arrived and stops.

    Every task writes a file for each hour it meets. A live stream meets one or two; a backlog
    of many hours should set ``files_per_hour``, which gathers each hour into at most that many
    tasks. The slice of an hour a row goes to is that of its input partition, so a busy hour
    spreads over all its slices.
    """
    landed = _by_hour(records, hour_of, files_per_hour)
    writer = landed.writeStream.format("text").partitionBy(*_LAYOUTS).option("path", root)
    return _started(writer, checkpoint, once)


def land_batches(
    records: DataFrame,
    root: str,
    checkpoint: str,
    hour_of: Column,
    once: bool = True,
    files_per_hour: int | None = None,
) -> StreamingQuery:
    """The same under ``root``/year=/month=/day=/hour=/batch=, with a manifest per day and batch
    in place of one log of all history.

    A micro-batch first writes its files, replacing its own folders should it run again, then the
    list of them, in ``root``/_manifest/date=/batch=. Files that no list names, those of a batch
    that was cut off or of a late attempt, are not read. What a reader opens to find a day's files
    is that day's lists, however long the history.
    """

    def land(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        # Written and asked for its hours: the source is read once.
        landed = _by_hour(batch, hour_of, files_per_hour).persist()
        try:
            (
                landed.withColumn("batch", F.lit(number))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(*_LAYOUTS, "batch")
                .text(root)
            )
            hours = [tuple(r) for r in landed.select(*_LAYOUTS).distinct().collect()]
        finally:
            landed.unpersist()
        lists = []
        for year, month, day, hour in hours:
            folder = f"year={year}/month={month}/day={day}/hour={hour}/batch={number}"
            lists += [
                (f"{year}-{month}-{day}", number, f"{folder}/{name}")
                for name in files_in(spark, f"{root}/{folder}")
            ]
        if lists:
            (
                spark.createDataFrame(lists, "date string, batch long, file string")
                .repartition("date")
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("date", "batch")
                .json(f"{root}/{MANIFEST}")
            )

    return _started(records.writeStream.foreachBatch(land), checkpoint, once)
