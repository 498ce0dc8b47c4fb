"""The daily job and the landing stream, end to end on small files."""

from __future__ import annotations

import dataclasses
import json

import pytest
from pyspark.sql import functions as F

from earshot import __main__ as command
from earshot import schemas
from earshot.plans import daily, enrich, views
from earshot.session import configure, fresh_folder
from earshot.sources.files import read_csv_table, read_hour_partitions
from earshot.streaming.landing import land_records


def lines(path, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(r) + "\n" for r in records))


def listen(user, track, time):
    return {"user_id": user, "track_id": track, "listen_time": time}


@pytest.fixture
def places(spark, tmp_path):
    lines(tmp_path / "in/users.json", [
        {"user_id": u, "user_name": f"u{u}", "user_age": 10 * u, "user_country": None,
         "created_at": "2024-06-20 10:00:00"} for u in (1, 2, 3)])
    lines(tmp_path / "in/songs.json", [
        {"id": n, "track_id": f"T{n % 3}", "artists": f"a{n}", "track_name": f"n{n}",
         "popularity": n, "duration_ms": 61000, "explicit": bool(n % 2), "tempo": 100.0,
         "track_genre": "pop"} for n in range(4)])
    lines(tmp_path / "in/topic/year=2025/month=06/day=20/hour=09/a.json", [
        listen(1, "T0", "2024-06-25 09:00:00"), listen(1, "T0", "2024-06-25 09:00:00"),
        listen(2, "T1", "2024-06-25 09:30:00"), listen(9, "T1", "2024-06-25 09:31:00"),
        listen(3, "X", "2024-06-25 10:00:00"), listen(3, "T2", None)])
    lines(tmp_path / "in/topic/year=2025/month=06/day=21/hour=00/a.json", [
        listen(1, "T1", "2024-06-25 09:45:00"), listen(None, "T2", "2024-06-26 00:00:00")])
    spark.sql("CREATE DATABASE IF NOT EXISTS music")
    yield daily.Locations(
        songs=str(tmp_path / "in/songs.json"),
        users=str(tmp_path / "in/users.json"),
        landing=str(tmp_path / "in/topic"),
        audits=str(tmp_path / "audits"),
        tables=str(tmp_path / "tables"),
        exports=str(tmp_path / "exports"),
    )
    spark.sql("DROP DATABASE music CASCADE")


MUSIC = views.Tables("music")


def test_daily_runs_add_days_and_repeat_safely(spark, places, rows):
    first = daily.run(spark, places, "2025-06-20", tables=MUSIC)
    assert (first.songs, first.users, first.streams, first.clean_streams) == (4, 3, 6, 5)
    assert (first.missing_users, first.missing_songs) == (1, 1)
    assert first.missing_values["streams"] == {"user_id": 0, "track_id": 0, "listen_time": 1}
    assert first.missing_values["users"]["user_country"] == 3
    hourly = rows(spark.table("music.view_hourly_kpi"))
    assert len(hourly) == 2 and sum(r[2] for r in hourly) == 3

    again = daily.run(spark, places, "2025-06-20", tables=MUSIC)
    assert again == first
    assert rows(spark.table("music.view_hourly_kpi")) == hourly

    second = daily.run(spark, places, "2025-06-21", tables=MUSIC)
    assert (second.streams, second.missing_users, second.missing_songs) == (2, 1, 0)
    assert spark.table("music.fact_streams").count() == 4
    summary = {r.track_id: r for r in spark.table("music.view_track_summary").collect()}
    assert {t: r.total_streams for t, r in summary.items()} == {"T0": 1, "T1": 2, "T2": 1}
    genre = spark.table("music.view_genre_kpi").first()
    assert (genre.total_streams, genre.total_track, genre.most_popular_track_id) == (4, 3, "T1")
    assert spark.table("music.dim_users").where("is_new_weekly").count() == 3
    assert spark.table("music.dim_songs").first().duration_min_sec == "1:01"


def test_audits_and_exports(spark, places):
    daily.run(spark, places, "2025-06-20", tables=MUSIC)
    audits = f"{places.audits}/2025-06-20"
    unknown = read_csv_table(spark, f"{audits}/missing_users", schemas.STREAMS).collect()
    assert [r.user_id for r in unknown] == [9]
    export = spark.read.option("header", True).csv(
        f"{places.exports}/2025-06-20/streams_full_cleaned"
    )
    assert export.count() == 3 and "track_genre" in export.columns


def test_hours_are_utc_whatever_the_session(spark, places, rows):
    daily.run(spark, places, "2025-06-20", tables=MUSIC)
    expected = rows(spark.table("music.view_hourly_kpi"))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Jakarta")
    try:
        command.main([
            "--songs", places.songs, "--users", places.users, "--landing", places.landing,
            "--audits", places.audits, "--tables", places.tables, "--database", "music",
        ])
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        assert rows(spark.table("music.view_hourly_kpi")) == expected
    finally:
        configure(spark)


def test_a_rerun_leaves_no_stale_audit(spark, places, tmp_path):
    daily.run(spark, places, "2025-06-20", tables=MUSIC)
    audits = tmp_path / "audits/2025-06-20"
    assert (audits / "missing_users").is_dir()
    lines(tmp_path / "in/topic/year=2025/month=06/day=20/hour=09/a.json", [
        listen(1, "T0", "2024-06-25 09:00:00"), listen(3, "X", "2024-06-25 10:00:00")])
    report = daily.run(spark, places, "2025-06-20", tables=MUSIC)
    assert report.missing_users == 0 and report.missing_songs == 1
    assert not (audits / "missing_users").exists() and (audits / "missing_songs").is_dir()


def test_a_play_landed_on_two_days_counts_once(spark, places, tmp_path):
    daily.run(spark, places, "2025-06-20", tables=MUSIC)
    before = spark.table("music.fact_streams").count()
    lines(tmp_path / "in/topic/year=2025/month=06/day=22/hour=00/a.json", [
        listen(1, "T0", "2024-06-25 09:00:00"), listen(2, "T2", "2024-06-25 09:00:00")])
    for _ in range(2):
        report = daily.run(spark, places, "2025-06-22", tables=MUSIC)
        assert report.clean_streams == 1
        assert report.daily_total == report.overall_total == before + 1
        assert spark.table("music.fact_streams").count() == before + 1


def test_further_columns_reach_the_fact(spark, places, tmp_path):
    daily.run(spark, places, "2025-06-20", tables=MUSIC)
    lines(tmp_path / "in/topic/year=2025/month=06/day=22/hour=00/a.json", [
        listen(1, "T0", "2024-06-26 09:00:00") | {"device": "phone", "artists": "mine"},
        listen(2, "T1", "2024-06-26 09:00:00")])
    daily.run(spark, places, "2025-06-22", tables=MUSIC)
    fact = spark.table("music.fact_streams").where("load_date = DATE'2025-06-22'")
    found = {r.user_id: (r.device, r.event_artists) for r in fact.collect()}
    assert found == {1: ("phone", "mine"), 2: ("Unknown", "Unknown")}
    assert spark.table("music.fact_streams").where("device IS NULL").count() == 3


def test_staging_is_removed_after_success_and_kept_after_failure(
    spark, places, tmp_path, monkeypatch
):
    shared = tmp_path / "shared"
    monkeypatch.setattr(daily, "fresh_folder", lambda _, label: f"{shared}/{label}-1")
    daily.run(spark, places, "2025-06-20", tables=MUSIC)
    assert list(shared.glob("daily-*")) == []
    assert len({fresh_folder(spark, "daily-2025-06-20") for _ in range(2)}) == 2
    (tmp_path / "audits/2025-06-20").rename(tmp_path / "gone")
    (tmp_path / "audits/2025-06-20").write_text("in the way")
    with pytest.raises(Exception):
        daily.run(spark, places, "2025-06-20", tables=MUSIC)
    assert len(list(shared.glob("daily-*"))) == 1


def test_torn_files_are_left_out_through_the_log(spark, places, tmp_path):
    root, source = str(tmp_path / "topic"), tmp_path / "source"
    lines(source / "1.json", [listen(1, "T0", "2025-06-20 09:59:59")])
    hour = F.to_timestamp(F.get_json_object("value", "$.listen_time"))
    records = spark.readStream.text(str(source))
    land_records(records, root, str(tmp_path / "checkpoint"), hour).awaitTermination()
    torn = tmp_path / "topic/year=2025/month=06/day=20/hour=09/part-torn.txt"
    torn.write_text('{"user_id": 2, "tra')
    with pytest.raises(Exception):
        daily.run(spark, dataclasses.replace(places, landing=root), "2025-06-20", tables=MUSIC)
    logged = dataclasses.replace(places, landing=root, listed_by="log")
    assert daily.run(spark, logged, "2025-06-20", tables=MUSIC).streams == 1


@pytest.mark.parametrize("rebalance", [False, True, None])
def test_files_of_many_dates(spark, places, tmp_path, rebalance):
    times = [f"2024-{1 + n % 12:02d}-{1 + n // 12:02d} 0{n % 9}:00:00" for n in range(120)]
    lines(tmp_path / "in/topic/year=2025/month=06/day=23/hour=00/a.json", [
        listen(1 + n % 3, f"T{n % 3}", time) for n, time in enumerate(times)])
    daily.run(spark, places, "2025-06-23", tables=MUSIC, rebalance=rebalance)
    files = list((tmp_path / "tables/fact_streams/load_date=2025-06-23").rglob("*.parquet"))
    assert spark.table("music.fact_streams").count() == 120
    assert len(files) == 120 or rebalance is False


def test_large_lookups_give_the_same_tables(spark, places, rows, monkeypatch):
    daily.run(spark, places, "2025-06-20", tables=MUSIC)
    expected = rows(spark.table("music.fact_streams"))
    monkeypatch.setattr(enrich, "is_small", lambda lookup: False)
    daily.run(spark, places, "2025-06-20", tables=MUSIC)
    assert rows(spark.table("music.fact_streams")) == expected


def test_command_line(spark, places, capsys):
    command.main([
        "--songs", places.songs, "--users", places.users, "--landing", places.landing,
        "--audits", places.audits, "--tables", places.tables, "--database", "music",
        "--day", "2025-06-21",
    ])
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report["clean_streams"] == 2 and report["missing_users"] == 1
    assert spark.table("music.fact_streams").count() == 1


def test_landing_goes_on_from_its_checkpoint(spark, tmp_path):
    source, root = tmp_path / "source", str(tmp_path / "topic")

    def land():
        records = spark.readStream.text(str(source))
        hour = F.to_timestamp(F.get_json_object("value", "$.listen_time"))
        land_records(records, root, str(tmp_path / "checkpoint"), hour).awaitTermination()
        return read_hour_partitions(spark, root, None, schemas.STREAMS, True, "log")

    lines(source / "1.json", [listen(1, None, "2025-06-20 09:59:59"),
                              listen(2, "T", "2025-06-20 10:00:00")])
    assert land().count() == 2
    assert (tmp_path / "topic/year=2025/month=06/day=20/hour=09").is_dir()
    lines(source / "2.json", [listen(3, "T", "2025-07-01 00:00:00")])
    landed = land()
    assert sorted((r.user_id, r.month, r.day, r.hour) for r in landed.collect()) == [
        (1, 6, 20, 9), (2, 6, 20, 10), (3, 7, 1, 0)]
    assert read_hour_partitions(spark, root, "2025-06-20", schemas.STREAMS).count() == 2
