from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot import schemas
from earshot.operators import profiling
from earshot.operators.cleaning import (
    apply_schema,
    drop_duplicates_first,
    fill_and_keep_first,
    fill_missing,
    parse_timestamps,
)
from earshot.plans import enrich


def test_fill_missing_by_type(spark):
    df = spark.createDataFrame(
        [(None, None, None, None, None, None), ("a", 1, float("nan"), True, None, None)],
        "s STRING, i INT, d DOUBLE, b BOOLEAN, t TIMESTAMP, n TIMESTAMP_NTZ",
    )
    end = dt.datetime(9999, 12, 31)
    first, second = fill_missing(df).orderBy("i").collect()
    assert tuple(first) == ("Unknown", 0, 0.0, False, end, end)
    assert tuple(second) == ("a", 1, 0.0, True, end, end)
    assert fill_missing(df).schema.simpleString() == df.schema.simpleString()


def test_parse_timestamps(spark):
    df = spark.createDataFrame([("2024-06-25 17:00:01.5",), (None,)], "t STRING")
    parsed = [r.t for r in parse_timestamps(df, ["t"]).collect()]
    assert parsed == [dt.datetime(2024, 6, 25, 17, 0, 1, 500000), None]
    junk = spark.createDataFrame([("soon",)], "t STRING")
    assert parse_timestamps(junk, ["t"], strict=False).collect() == [(None,)]
    laid_out = spark.createDataFrame([("25/06/2024",)], "t STRING")
    assert parse_timestamps(laid_out, ["t"], "dd/MM/yyyy").first().t == dt.datetime(2024, 6, 25)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_junk_times_fail_whatever_the_ansi_setting(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="not a timestamp"):
            parse_timestamps(spark.createDataFrame([("soon",)], "t STRING"), ["t"]).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_typed_times_stay(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "t TIMESTAMP")
    assert parse_timestamps(df, ["t"]).schema == df.schema


def test_apply_schema_casts_and_passes_others_through(spark):
    df = spark.createDataFrame(
        [(12.0, "true", "2024-01-01 10:00:00", "x"), (float("nan"), None, None, "y")],
        "id DOUBLE, explicit STRING, created_at STRING, extra STRING",
    )
    schema = schemas.SONGS.__class__(
        [schemas.SONGS["id"], schemas.SONGS["explicit"], schemas.USERS["created_at"]]
    )
    typed = apply_schema(df, schema)
    assert typed.schema.simpleString() == (
        "struct<id:int,explicit:int,created_at:timestamp,extra:string>"
    )
    assert [tuple(r) for r in typed.orderBy("extra").collect()] == [
        (12, 1, dt.datetime(2024, 1, 1, 10), "x"),
        (None, None, None, "y"),
    ]


def test_keep_first_by_order(spark):
    df = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", 5, "only")],
                               "k STRING, id INT, v STRING")
    kept = drop_duplicates_first(df, ["k"], ["id"])
    assert sorted(map(tuple, kept.collect())) == [("a", 1, "early"), ("b", 5, "only")]


def test_keep_first_breaks_ties_by_the_other_columns(spark):
    df = spark.createDataFrame([("a", 1, v) for v in "zyx"], "k STRING, id INT, v STRING")
    kept = drop_duplicates_first(df.repartition(3), ["k"], ["id"])
    assert [tuple(r) for r in kept.collect()] == [("a", 1, "x")]


def test_null_keys_fill_before_deduplication(spark):
    df = spark.createDataFrame(
        [(None, "t", "2024-01-01 00:00:00"), (0, "t", "2024-01-01 00:00:00")],
        "user_id INT, track_id STRING, listen_time STRING",
    )
    assert enrich.clean_streams(df).count() == 1


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.text("ab", max_size=2))))
def test_deduplication_is_idempotent(spark, data):
    df = spark.createDataFrame(data, "k INT, o INT, v STRING")
    once = drop_duplicates_first(df, ["k"], ["o"])
    assert sorted(map(tuple, once.collect())) == sorted(
        min((r for r in data if r[0] == k), key=lambda r: r[1:]) for k in {r[0] for r in data}
    )
    assert drop_duplicates_first(once, ["k"], ["o"]).count() == once.count()


def test_profiles(spark):
    df = spark.createDataFrame([(1, float("nan")), (1, None), (None, 2.0)], "k INT, v DOUBLE")
    missing = dict(map(tuple, profiling.null_profile(df).collect()))
    assert missing == {"k": 1, "v": 2}
    assert profiling.has_missing(df) and not profiling.has_missing(fill_missing(df))
    assert [tuple(r) for r in profiling.duplicate_profile(df, ["k"]).collect()] == [(1, 2)]
    assert [tuple(r) for r in profiling.profile({"t": df}).collect()] == [("t", 3, 2)]
    assert profiling.column_types(df) == [("k", "int"), ("v", "double")]
    assert profiling.preview(df, 2, [F.col("k").desc()]).count() == 2


def test_fractions_are_no_whole_numbers(spark):
    schema = T.StructType([T.StructField("age", T.IntegerType())])
    whole = spark.createDataFrame([("19.0",), (None,), ("NaN",)], "age string")
    assert [r.age for r in apply_schema(whole, schema).collect()] == [19, None, None]
    with pytest.raises(Exception, match="not a whole number in age: 19.7"):
        apply_schema(spark.createDataFrame([("19.7",)], "age string"), schema).collect()


def test_a_missing_order_comes_last(spark):
    df = spark.createDataFrame([(None, "a"), (3, "b"), (5, "c")], "id int, name string")
    kept = fill_and_keep_first(df.withColumn("k", F.lit(1)), ["k"], ["id"])
    assert [tuple(r) for r in kept.select("id", "name").collect()] == [(3, "b")]
