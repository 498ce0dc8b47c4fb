"""Session settings the jobs rely on, and the shared folder for intermediate data."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings, safe to set on a session somebody else built.
SETTINGS = {
    # listen_time carries no zone; hours and dates are cut in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Bad numbers and timestamps fail the job instead of turning into nulls.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Without this, a skewed join feeding a group-by on the same key stays unsplit.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


# The folder a session on one machine uses that names none.
_own_folder: list[str] = []


def name_own_folder(spark: SparkSession) -> None:
    """Give a session a temporary folder of its own where spark.checkpoint.dir is unset and all
    runs on one machine, as in tests."""
    unset = not spark.conf.get("spark.checkpoint.dir", None)
    if unset and not _own_folder and spark.sparkContext.master.startswith("local["):
        _own_folder.append(tempfile.mkdtemp(prefix="shared-"))


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.
    None is guessed: a folder on one machine would lose what the others write."""
    named = spark.conf.get("spark.checkpoint.dir", None) or next(iter(_own_folder), None)
    if not named:
        raise ValueError("name a folder all executors share in spark.checkpoint.dir")
    return named.rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A folder of its own under the shared one, so that runs never meet."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, folder: str) -> DataFrame:
    """Write ``df`` as Parquet and go on from the files.

    Later jobs read the columns they need instead of recomputing the lineage, and a lost
    executor costs a re-read, not a recomputation.
    """
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def together(spark: SparkSession, *steps: Callable[[], Any]) -> list[Any]:
    """The results of steps that don't need one another, whose jobs run side by side. All of them
    end before the first failure, if there is one, is raised."""
    with ThreadPoolExecutor(len(steps)) as pool:
        begun = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [step.result() for step in begun]


def exists(spark: SparkSession, folder: str) -> bool:
    """Whether there is something at a path, on whatever store it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def files_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the data files in one folder; hidden ones and markers are left out."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    names = sorted(f.getPath().getName() for f in found if f.isFile())
    return [n for n in names if not n.startswith(("_", "."))]


def remove_folder(spark: SparkSession, folder: str) -> bool:
    """Delete a folder on whatever store it is; returns whether there was one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# Rows a shuffle partition should hold at most, and the most partitions to plan for: beyond it
# the map side would spend more on bookkeeping than the smaller partitions save.
ROWS_PER_PARTITION = 2_000_000
MOST_PARTITIONS = 50_000


def size_shuffles(spark: SparkSession, rows: int, most: int = MOST_PARTITIONS) -> None:
    """Start shuffles with partitions for ``rows`` rows, at least as many as configured and at
    most ``most``. Adaptive execution merges those that turn out small."""
    wanted = min(-(-rows // ROWS_PER_PARTITION), most)
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum", max(wanted, configured)
    )
