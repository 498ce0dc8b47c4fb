"""Bucket edges and other literal cases."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from earshot.functions import (
    age_group,
    duration_min_sec,
    duration_s,
    flag_to_int,
    is_new_weekly,
    tempo_level,
)


def values(spark, schema, given_values, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(given_values)], f"i INT, v {schema}")
    return [r[0] for r in df.select(column(F.col("v")).alias("x"), "i").orderBy("i").collect()]


def test_age_group(spark):
    ages = [9, 10, 19, 20, 99, 100, None]
    expected = ["nan", "10-19", "10-19", "20-29", "90-99", "nan", "nan"]
    assert values(spark, "INT", ages, age_group) == expected
    unknown = values(spark, "INT", [9, 55, None], lambda c: age_group(c, "Unknown"))
    assert unknown == ["Unknown", "50-59", "Unknown"]


def test_age_group_takes_half_open_ranges(spark):
    assert values(spark, "DOUBLE", [19.5, float("nan")], age_group) == ["10-19", "nan"]


def test_tempo_level(spark):
    tempi = [-1.0, 0.0, 0.1, 90.0, 90.01, 120.0, 120.01, float("inf"), float("nan"), None]
    expected = ["nan", "nan", "slow", "slow", "medium", "medium", "fast", "fast", "nan", "nan"]
    assert values(spark, "DOUBLE", tempi, tempo_level) == expected


def test_is_new_weekly(spark):
    times = [
        dt.datetime(2024, 6, 18, 23, 59, 59),
        dt.datetime(2024, 6, 19),
        dt.datetime(2024, 6, 25, 23, 59, 59),
        dt.datetime(2024, 6, 26),
        None,
    ]
    expected = [False, True, True, False, False]
    assert values(spark, "TIMESTAMP_NTZ", times, is_new_weekly) == expected
    later = values(spark, "TIMESTAMP_NTZ", times, lambda c: is_new_weekly(c, "2024-07-02"))
    assert later == [False, False, False, True, False]


def test_durations(spark):
    lengths = [0, 999, 1000, 59999, 60000, 230666, 3600000, -1, None]
    text = ["0:00", "0:00", "0:01", "0:59", "1:00", "3:50", "60:00", "-1:59", None]
    assert values(spark, "INT", lengths, duration_min_sec) == text
    assert values(spark, "INT", [230666, None], duration_s) == [230.666, None]


def test_flag_to_int(spark):
    texts = ["true", "False", "1", "0", "1.0", None]
    assert values(spark, "STRING", texts, flag_to_int) == [1, 0, 1, 0, 1, None]
    assert values(spark, "BOOLEAN", [True, False, None], flag_to_int) == [1, 0, None]
    with pytest.raises(Exception, match="not a flag"):
        values(spark, "STRING", ["maybe"], flag_to_int)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(-5, 10**8), min_size=1, max_size=50))
def test_duration_text_matches_integer_arithmetic(spark, lengths):
    expected = [f"{x // 60000}:{x % 60000 // 1000:02d}" for x in lengths]
    assert values(spark, "INT", lengths, duration_min_sec) == expected
