"""The sliced join gives the rows of the plain one, whatever the skew."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from earshot.operators import lookup


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the events on one key, some keys unknown, some null."""
    events = spark.range(3000).select(
        F.col("id").alias("event"),
        F.expr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id % 40 END").alias("k"),
    )
    table = spark.range(30).select(
        F.col("id").alias("k"), F.concat(F.lit("v"), F.col("id")).alias("v")
    )
    return events, table


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_sliced_equals_plain(spark, skewed, rows, how, broadcast):
    events, table = skewed
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        sliced = lookup.lookup_join(events, table, "k", how, rows_per_slice=20)
        plain = events.join(table, "k", how).select(*sliced.columns)
        assert "_slice" not in sliced.columns
        assert rows(sliced) == rows(plain)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_only_small_lookups_are_broadcast(skewed):
    events, table = skewed

    def plan(small):
        joined = lookup.lookup_join(events, table, "k", small=small)
        return joined._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(True) and "_slice" not in plan(True)
    assert "_slice" in plan(False)


def test_small_means_few_rows_and_little_text(spark, skewed, monkeypatch):
    _, table = skewed
    assert lookup.is_small(table) and lookup.is_small(table.limit(0))
    assert not lookup.is_small(table.select("k", F.repeat("v", 2_000_000).alias("v")))
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 29)
    assert not lookup.is_small(table)


def test_hot_keys_and_their_slices(skewed):
    events, _ = skewed
    hot = {r["k"]: r["_slices"] for r in lookup.hot_keys(lookup.key_counts(events, "k"), "k", 100).collect()}
    count = events.where("k = 7").count()
    assert hot == {7: -(-count // 100)}


def test_slices_spread_a_hot_key(spark, skewed):
    """After slicing, no join key holds much more than the rows aimed at."""
    events, table = skewed
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup.lookup_join(events, table, "k", rows_per_slice=100)
        text = joined._jdf.queryExecution().optimizedPlan().toString()
        assert "Join Inner, ((k#" in text and "_slice#" in text
        biggest = (
            joined.where("k = 7")
            .groupBy(F.pmod(F.xxhash64("event", "k"), F.lit(11)).alias("s")).count()
            .agg(F.max("count")).first()[0]
        )
        assert biggest < 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_empty_sides(skewed, rows):
    events, table = skewed
    assert rows(lookup.lookup_join(events.limit(0), table, "k")) == []
    assert lookup.lookup_join(events, table.limit(0), "k", "left").count() == 3000


def test_other_joins_are_refused(skewed):
    events, table = skewed
    with pytest.raises(ValueError):
        lookup.lookup_join(events, table, "k", "right")


def test_any_number_of_hot_keys_is_sliced(spark, rows, monkeypatch):
    events = spark.range(60_000).select(
        F.col("id").alias("event"), F.expr("if(id % 10 = 0, NULL, id % 6000)").alias("k")
    )
    table = spark.range(6000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    plain = rows(events.join(table, "k", "left").select("event", "k", "v"))
    hot = lookup.hot_keys(lookup.key_counts(events, "k"), "k", 5)
    assert hot.count() == 5401  # the null key too
    assert rows(lookup.lookup_join(events, table, "k", "left", rows_per_slice=5)) == plain
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 100)
    assert rows(lookup.lookup_join(events, table, "k", "left", rows_per_slice=5)) == plain
