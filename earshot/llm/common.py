"""Helpers the operators share: staging, small-table bounds and Arrow batch sizes."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from earshot.session import fresh_folder, name_own_folder, remove_folder

# Rows and bytes of text a Python worker is handed at a time.
ARROW_ROWS = 512
ARROW_BYTES = 16 << 20


_PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, where it need not be installed. Once a session."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        target = f"{tempfile.mkdtemp(prefix='ship-')}/{_PACKAGE.name}.zip"
        with zipfile.ZipFile(target, "w") as packed:
            for file in sorted(_PACKAGE.rglob("*.py")):
                packed.write(file, file.relative_to(_PACKAGE.parent))
        context.addPyFile(target)
        _shipped.add(context.applicationId)


def prepare(spark: SparkSession) -> SparkSession:
    """Ship the package, bound the batches Python workers get, and see that a shared folder is
    named.

    On a cluster the folder must be named in spark.checkpoint.dir; only a session on one
    machine (tests, local runs) gets a folder of its own.
    """
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    name_own_folder(spark)
    return spark


# Folders staged and not removed yet, in the order they were written.
_folders: list[str] = []


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder once, tightly, and go on from its files."""
    folder = fresh_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(folder)
    _folders.append(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def staged_so_far() -> int:
    """A mark for ``remove_staged``."""
    return len(_folders)


def remove_staged(spark: SparkSession, since: int, *still_read: DataFrame) -> None:
    """Remove what was staged after the mark, but for the files that some frames read. Called when
    all that needed it is written; after a failure it isn't, and the folders stay."""
    files = [file for df in still_read for file in df.inputFiles()]
    for folder in _folders[since:]:
        name = folder.rsplit("/", 1)[1]
        if not any(f"/{name}/" in file for file in files):
            remove_folder(spark, folder)
            _folders.remove(folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# More partitions than this are not planned for.
MOST_PARTITIONS = 10_000


def partitions(spark: SparkSession, rows: int, rows_each: int) -> int:
    """Partitions for ``rows`` rows, at least as many as the session has for shuffles."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(MOST_PARTITIONS, -(-rows // rows_each)))


def partitions_for(df: DataFrame, rows_each: int) -> int:
    """The same for a table whose rows are counted, which Parquet footers tell."""
    return partitions(df.sparkSession, df.count(), rows_each)
