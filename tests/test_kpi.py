"""Ties, twins and totals of the KPIs."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks.fixtures import Inputs
from earshot.plans import dims, enrich, facts, kpi, views
from tests.conftest import MEDIUM, SMALL


@pytest.fixture(scope="module")
def dirty(spark):
    i = Inputs(spark, SMALL)
    return facts.fact_streams(i.enriched_dirty), dims.dim_songs(i.clean_songs), i


def play(user, track, hour, genre="g", artist="a", age=25, day=1):
    return (user, track, dt.datetime(2024, 1, day, hour), dt.date(2024, 1, day), hour, genre,
            artist, age, 50, 1000)


PLAY = (
    "user_id INT, track_id STRING, listen_time TIMESTAMP_NTZ, listen_date DATE, listen_hour INT,"
    "track_genre STRING, artists STRING, user_age INT, popularity INT, duration_ms INT"
)


def test_ties_go_to_the_lowest_label(spark, rows):
    fact = spark.createDataFrame(
        [play(1, "t1", 0, "b"), play(2, "t1", 0, "b"), play(3, "t2", 0, "a"), play(4, "t3", 0, "a"),
         play(5, "t4", 0, "c")],
        PLAY,
    )
    assert kpi.top_genre_hourly(fact).first().track_genre == "a"
    assert kpi.hourly_kpi(fact).first().top_genre == "a"
    tops = rows(kpi.most_popular_track(fact))
    assert tops == [("a", "t2", 1), ("b", "t1", 2), ("c", "t4", 1)]


def test_unknown_age_can_win(spark):
    fact = spark.createDataFrame([play(1, "t", 0, age=5), play(2, "t", 0, age=104),
                                  play(3, "t", 0, age=30)], PLAY)
    assert kpi.hourly_kpi(fact).first().top_age_group == "Unknown"
    assert kpi.top_age_group_hourly(fact).first().age_group == "Unknown"


def test_tops_keep_dates_apart(spark, rows):
    fact = spark.createDataFrame(
        [play(1, "x", 0, "g"), play(1, "y", 0, "g", day=2), play(2, "y", 0, "g", day=2)], PLAY
    )
    daily = rows(kpi.most_popular_track_daily(fact))
    assert daily == [(dt.date(2024, 1, 1), "g", "x", 1), (dt.date(2024, 1, 2), "g", "y", 2)]
    assert len(rows(kpi.hourly_kpi(fact))) == 2


def test_null_labels_rank_last_and_can_win(spark):
    fact = spark.createDataFrame([play(1, "t", 0, None), play(2, "t", 0, "g")], PLAY)
    assert kpi.hourly_kpi(fact).first().top_genre == "g"
    alone = spark.createDataFrame([play(1, "t", 0, None)], PLAY)
    assert kpi.hourly_kpi(alone).first().top_genre is None


def test_ratio_of_no_tracks_is_null(spark):
    songs = spark.createDataFrame([(None, 1, "g")], "track_id STRING, explicit INT, track_genre STRING")
    assert kpi.genre_explicit(songs).first().explicit_ratio is None


def test_flags_may_be_boolean(spark):
    songs = spark.createDataFrame([("t", True, "g"), ("u", False, "g")],
                                  "track_id STRING, explicit BOOLEAN, track_genre STRING")
    assert tuple(kpi.genre_explicit(songs).first()) == ("g", 2, 1, 0.5)


def test_popularity_order(dirty):
    fact, songs, _ = dirty
    plays = [r.total_streams for r in kpi.track_popularity(fact, songs).collect()]
    assert plays == sorted(plays, reverse=True)
    assert [r.total_streams for r in kpi.track_popularity(fact, songs, 5).collect()] == plays[:5]


@pytest.mark.parametrize("name", list(views.VIEWS))
def test_views_equal_their_data_frame_twins(spark, rows, dirty, name):
    fact, songs, _ = dirty
    twin = {
        "view_genre_kpi": lambda: kpi.genre_kpi(fact, songs),
        "view_daily_genre_kpi": lambda: kpi.daily_genre_kpi(fact),
        "view_hourly_kpi": lambda: kpi.hourly_kpi(fact),
        "view_track_summary": lambda: kpi.track_summary(fact, songs),
    }[name]()
    view = spark.sql(views.VIEWS[name], fact=fact, songs=songs)
    assert view.columns == twin.columns
    assert view.dtypes == twin.dtypes
    assert rows(view) == rows(twin)


def test_totals_agree(dirty):
    fact, songs, i = dirty
    events = fact.count()
    for frame in (kpi.hourly_kpi(fact), kpi.genre_kpi(fact, songs), kpi.daily_genre_kpi(fact),
                  kpi.track_summary(fact, songs)):
        assert frame.agg(F.sum("total_streams")).first()[0] == events
    totals = kpi.reconcile_totals(fact).first()
    assert (totals.daily_total, totals.overall_total, totals.matches) == (events, events, True)


def test_joined_and_unmatched_events_make_up_all(dirty):
    """Left rows = all events; an event is joined, or misses its user, or misses its song."""
    _, _, i = dirty
    clean = i.clean_streams
    left = enrich.enrich_streams(clean, i.clean_users, i.clean_songs, "left", i.sizes)
    no_user = enrich.missing_users(clean, i.clean_users)
    no_song = enrich.missing_songs(clean, i.clean_songs)
    unmatched = no_user.union(no_song).distinct().count()
    assert left.count() == clean.count() == i.enriched_dirty.count() + unmatched
    assert left.where("user_name IS NULL").count() == no_user.count()
    assert left.where("track_name IS NULL").count() == no_song.count()


# Row counts stated with the fixtures, per data folder.
GOLDEN = {
    SMALL: {
        "fact": 1000, "genres": 6, "hours": 531, "tracks": 100, "daily_genres": 180,
        "young_or_old_plays": 315, "new_users": 35, "streams_dirty": 1100, "songs_dirty": 204,
        "streams_clean": 1000, "songs_clean": 200, "missing_users": 131, "missing_songs": 139,
        "fact_dirty": 749, "undated": 33, "summary_raw": 102,
    },
    MEDIUM: {
        "fact": 10000, "genres": 6, "hours": 720, "tracks": 100, "daily_genres": 180,
        "young_or_old_plays": 934, "new_users": 350, "streams_dirty": 11000, "songs_dirty": 2040,
        "streams_clean": 9989, "songs_clean": 2000, "missing_users": 1309, "missing_songs": 1385,
        "fact_dirty": 7476, "undated": 321, "summary_raw": 102,
    },
}


@pytest.mark.parametrize("folder", list(GOLDEN))
def test_golden_counts(spark, folder):
    i = Inputs(spark, folder)
    fact, songs = facts.fact_streams(i.enriched), dims.dim_songs(i.songs)
    fact_dirty = facts.fact_streams(i.enriched_dirty)
    audits = dict(map(tuple, enrich.audit_counts(i.clean_streams, i.clean_users, i.clean_songs)
                      .collect()))
    found = {
        "fact": fact.count(),
        "genres": kpi.genre_kpi(fact, songs).count(),
        "hours": kpi.hourly_kpi(fact).count(),
        "tracks": kpi.track_summary(fact, songs).count(),
        "daily_genres": kpi.daily_genre_kpi(fact).count(),
        "young_or_old_plays": fact.where("user_age < 10 OR user_age >= 100").count(),
        "new_users": dims.dim_users(i.users).where("is_new_weekly").count(),
        "streams_dirty": i.streams_dirty.count(),
        "songs_dirty": i.songs_dirty.count(),
        "streams_clean": i.clean_streams.count(),
        "songs_clean": i.clean_songs.count(),
        **audits,
        "fact_dirty": facts.fact_streams(
            enrich.enrich_streams(i.clean_streams, i.users, i.clean_songs)
        ).count(),
        "undated": fact_dirty.where("listen_date = DATE'9999-12-31'").count(),
        "summary_raw": kpi.track_summary(fact_dirty, dims.dim_songs(i.songs_dirty)).count(),
    }
    assert found == GOLDEN[folder]
