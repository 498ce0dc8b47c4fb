"""JSON-lines and CSV exports, written by the executors to any file or object-store URI."""

from __future__ import annotations

from pyspark.sql import DataFrame

from earshot.session import remove_folder

# Whole microseconds; the writer's default cuts them to milliseconds.
_TIME_LAYOUT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per line, with nulls spelled out."""
    (
        df.write.mode("overwrite")
        .option("ignoreNullFields", False)
        .option("timestampFormat", _TIME_LAYOUT)
        .option("timestampNTZFormat", _TIME_LAYOUT)
        .json(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; quotes are doubled, as data-frame readers expect."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("timestampFormat", _TIME_LAYOUT)
        .option("timestampNTZFormat", _TIME_LAYOUT)
        .csv(path)
    )


def write_audit(df: DataFrame, path: str, rows: int | None = None) -> bool:
    """Replace an audit set by ``df`` as CSV; without rows by none at all. Returns whether there
    were rows. A known count in ``rows`` saves looking."""
    if rows == 0 or (rows is None and df.isEmpty()):
        remove_folder(df.sparkSession, path)
        return False
    write_csv(df, path)
    return True
