"""Run registered queries in Spark and DuckDB and compare rows, names and types.

python -m checks.compare [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import all_oracles
from checks.queries import all_queries

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()  # fmt: skip

# Spark's type names for DuckDB's.
_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """DuckDB inside this process, with the given tables as views."""
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def difference(con: duckdb.DuckDBPyConnection, df: DataFrame, sql: str) -> str | None:
    """What differs between the two results, or None."""
    names = sorted(df.columns)
    relation = con.sql(sql)
    expected_types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    if names != sorted(expected_types):
        return f"columns {names} against {sorted(expected_types)}"
    types = dict(df.dtypes)
    wrong = [n for n in names if types[n] != _TYPES.get(expected_types[n], expected_types[n])]
    if wrong:
        return f"types {[(n, types[n], expected_types[n]) for n in wrong]}"
    quoted = ", ".join(f'"{n}"' for n in names)
    expected = Counter(con.sql(f"SELECT {quoted} FROM ({sql})").fetchall())
    found = Counter(tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect())
    if found == expected:
        return None
    return (
        f"{found.total()} rows against {expected.total()}; "
        f"only here {list((found - expected).items())[:3]}; "
        f"only expected {list((expected - found).items())[:3]}"
    )


def main(arguments: list[str]) -> int:
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracles = connect(sf_dir), all_queries(), all_oracles()
    failed = [f"{n}: only on one side" for n in sorted(set(queries) ^ set(oracles))]
    for name in arguments[1:] or queries:
        start = time.perf_counter()
        try:
            found = difference(con, queries[name](spark, sf_dir), oracles[name])
        except Exception as error:  # one query's failure should not hide the others'
            found = f"{type(error).__name__}: {str(error)[:500]}"
        print(f"{name:28s} {time.perf_counter() - start:6.2f}s {found or 'ok'}", flush=True)
        failed += [name] if found else []
    print(f"{Path(sf_dir).name}: {len(failed)} failed {failed}")
    return len(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
