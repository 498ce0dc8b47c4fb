"""Every registered query against DuckDB, and the shape of its plan."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from checks import queries
from checks.compare import connect, difference
from checks.fixtures import Inputs
from checks.oracle import all_oracles
from checks.queries import all_queries
from tests.conftest import SMALL

QUERIES = all_queries()
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows_as_duckdb(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    assert difference(duck, df, ORACLES[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert operator not in plan


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:2] == ["listen_date", "listen_hour"] and df.count() > 0


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_needed_columns_are_read(spark):
    plan = final_plan(QUERIES["genre_explicit"](spark, SMALL))
    assert "ReadSchema: struct<p_partkey:bigint,p_type:string>" in plan


def test_top_one_prunes_before_the_shuffle(spark):
    for name in ("clean_songs", "most_popular_track", "top_artist_hourly"):
        plan = final_plan(QUERIES[name](spark, SMALL))
        assert "WindowGroupLimit" in plan and "Partial" in plan


def test_hourly_kpi_scans_the_fact_twice(spark):
    plan = final_plan(QUERIES["hourly_kpi"](spark, SMALL))
    assert plan.count("/fact-") == 2


def test_json_arrays_do_not_grow_with_the_table(spark, monkeypatch):
    folders, plain = [], queries.fresh_folder

    def folder(*args):
        folders.append(plain(*args))
        return folders[-1]

    def many(i):
        n = i.songs.count()
        copies = i.songs.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(60_000 // n))))
        return copies.withColumn("id", F.col("id") + F.col("_copy") * n).drop("_copy")

    monkeypatch.setattr(queries, "fresh_folder", folder)
    monkeypatch.setattr(Inputs, "songs_dirty", property(many))
    read = QUERIES["json_array_round_trip"](spark, SMALL)
    assert read.count() >= 60_000 and read.count() == read.select("id").distinct().count()
    arrays = spark.read.text(folders[0], wholetext=True)
    assert arrays.agg(F.max(F.json_array_length("value"))).first()[0] <= 10_000
