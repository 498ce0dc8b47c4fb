"""Replacing database tables from executors."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column types of the source database, but for DOUBLE: its FLOAT is a 32-bit number
# to Spark and would cut fractions.
_COLUMN_TYPES = {
    T.StringType: "VARCHAR(255)",
    T.IntegerType: "INT",
    T.LongType: "INT",
    T.DoubleType: "DOUBLE",
    T.BooleanType: "BOOLEAN",
}
_OTHER_TYPE = "TEXT"
BATCH_ROWS = 1000


def jdbc_column_types(schema: T.StructType) -> dict[str, str]:
    """The database type of each column."""
    return {f.name: _COLUMN_TYPES.get(type(f.dataType), _OTHER_TYPE) for f in schema.fields}


def nan_to_null(df: DataFrame) -> DataFrame:
    """Databases have no NaN; a missing fraction is a null there."""
    fractions = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    return df.withColumns({c: F.nanvl(F.col(f"`{c}`"), F.lit(None)) for c in fractions})


def jdbc_options(
    schema: T.StructType, long_text: tuple[str, ...] = (), connections: int = 16
) -> dict[str, str]:
    """Writer options: declared types, batch size and the limit on open connections.

    Columns in ``long_text``, and those without a declared type, get the driver's text type;
    unbounded text does not fit VARCHAR(255). 64-bit integers keep the driver's type too,
    since INT would refuse large values.
    """
    declared = ", ".join(
        f"`{f.name}` {kind}"
        for f, kind in zip(schema.fields, jdbc_column_types(schema).values(), strict=True)
        if kind != _OTHER_TYPE
        and f.name not in long_text
        and not isinstance(f.dataType, T.LongType)
    )
    options = {"batchsize": str(BATCH_ROWS), "numPartitions": str(connections)}
    return {**options, "createTableColumnTypes": declared} if declared else options


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    options: Mapping[str, str],
    long_text: tuple[str, ...] = (),
    connections: int = 16,
) -> None:
    """Drop, create and fill a table, in batches, over at most ``connections`` connections.

    ``options`` carries driver, user and password; none is kept here.
    """
    (
        nan_to_null(df)
        .write.format("jdbc")
        .mode("overwrite")
        .options(**jdbc_options(df.schema, long_text, connections))
        .options(**options)
        .option("url", url)
        .option("dbtable", table)
        .save()
    )
