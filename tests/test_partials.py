"""Mergeable partials, the landing manifest and the bucketed fact."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from checks import queries
from earshot import schemas
from earshot.operators import lookup
from earshot.operators.lookup import key_counts, lookup_join
from earshot.operators.ordinal import with_ordinal
from earshot.operators.profiling import Counted, null_profile
from earshot.plans import daily, enrich, kpi, partials, views
from earshot.session import fresh_folder
from earshot.sinks.tables import buckets_of, write_fact
from earshot.sources import files
from earshot.sources.files import read_hour_partitions
from earshot.sources.records import stage_records
from earshot.streaming.landing import MANIFEST, land_batches

FACT = (
    "user_id long, track_id string, listen_time timestamp, user_age int, artists string, "
    "popularity int, duration_ms int, track_genre string"
)
TABLES = views.Tables("kept")


def play(user, track, time, genre="pop", popularity=3):
    return (user, track, dt.datetime.fromisoformat(time), 20 + (user or 0) % 90, f"a{track}",
            popularity, 1000, genre)


@pytest.fixture
def database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS kept")
    spark.createDataFrame(
        [("T0", "pop", 1, "n", "a", 1), ("T1", "rock", 0, "n", "a", 2), ("T2", None, 0, "n", "a", 3)],
        "track_id string, track_genre string, explicit int, track_name string, artists string, "
        "popularity int",
    ).write.mode("overwrite").saveAsTable("kept.dim_songs")
    yield
    spark.sql("DROP DATABASE kept CASCADE")


def load(spark, plays, day, rows=4_000_000):
    fact = spark.createDataFrame(plays, FACT).withColumns(
        {"listen_date": F.to_date("listen_time"), "listen_hour": F.hour("listen_time")}
    )
    write_fact(fact, TABLES.fact, day, rows=rows)
    partials.store_day(spark, TABLES, day)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def same_as_views(spark, rows):
    fact, songs = spark.table(TABLES.fact), spark.table(TABLES.songs)
    for name, expected in (
        ("genre_kpi", kpi.genre_kpi(fact, songs)),
        ("daily_genre_kpi", kpi.daily_genre_kpi(fact)),
        ("hourly_kpi", kpi.hourly_kpi(fact)),
    ):
        found = spark.table(TABLES.named(f"partial_{name}"))
        assert sorted(found.columns) == sorted(expected.columns)
        assert rows(found.select(expected.columns)) == rows(expected)
    hours = ["listen_date", "listen_hour"]
    merged = partials.listeners_merged(spark.table(TABLES.named("partial_hour_listeners")), hours)
    exact = fact.groupBy(*hours).agg(F.count_distinct("user_id"))
    assert rows(merged) == rows(exact)


DAY_1 = [play(u, f"T{u % 3}", f"2024-06-25 0{u % 4}:00:00", "pop" if u % 2 else "rock")
         for u in range(1, 60)] + [play(7, "T2", "2024-06-25 01:30:00", None, None)]
DAY_2 = [play(u, f"T{u % 2}", f"2024-06-2{5 + u % 2} 03:00:00") for u in range(40, 90)]
DAY_2 += [play(2**40 + u, "T1", "9999-12-31 00:00:00") for u in range(3)]


def test_partials_are_the_views_after_any_rerun(spark, rows, database):
    load(spark, DAY_1, "2024-06-25")
    load(spark, DAY_2, "2024-06-26")
    views.create_views(spark, TABLES, partials=True)
    same_as_views(spark, rows)
    numbers = rows(spark.table("kept.user_numbers"))
    assert sorted(n for _, n in numbers) == list(range(1, len(numbers) + 1))
    # Fewer plays, another user, and the plays of the other load day untouched.
    load(spark, DAY_1[:20] + [play(1000, "T1", "2024-06-25 02:00:00")], "2024-06-25")
    same_as_views(spark, rows)
    again = rows(spark.table("kept.user_numbers"))
    assert [x for x in again if x in numbers] == numbers and len(again) == len(numbers) + 1
    load(spark, [], "2024-06-26")
    same_as_views(spark, rows)


def test_partials_read_no_fact(spark, database):
    load(spark, DAY_1, "2024-06-25")
    for name in views.create_views(spark, TABLES, partials=True):
        if ".partial_" in name:
            df = spark.table(name)
            assert "fact_streams" not in executed(df)
            assert not [f for f in df.inputFiles() if "fact_streams" in f]


def test_partials_with_lookups_that_are_not_broadcast(spark, rows, database, monkeypatch):
    monkeypatch.setattr(partials, "is_small", lambda lookup: False)
    load(spark, DAY_1, "2024-06-25")
    views.create_views(spark, TABLES, partials=True)
    same_as_views(spark, rows)


def test_bitmaps_span_buckets_and_hold_repeats_once(spark):
    pairs = spark.range(1, 100_001).select(
        (F.col("id") % 2).alias("g"), F.col("id").alias("number")
    )
    found = partials.listeners(pairs.unionByName(pairs), ["g"])
    assert found.count() == 8 and found.select("listeners").first()[0].__len__() == 4096
    assert {r.g: r.unique_listeners for r in partials.listeners_merged(found, ["g"]).collect()} == {
        0: 50_000, 1: 50_000
    }


def test_sketches_of_parts_are_those_of_the_whole(spark):
    plays = spark.range(200_000).select(
        (F.col("id") % 70_001).alias("user_id"), F.lit("2024-01-01").alias("listen_date"),
        (F.col("id") % 3).alias("listen_hour"), (F.col("id") % 5).alias("part"),
    )
    whole = partials.hour_sketches(plays)
    parts = [partials.hour_sketches(plays.where(F.col("part") == n)) for n in range(5)]
    many = parts[0]
    for part in parts[1:]:
        many = many.unionByName(part)
    for keys, exact in ((["listen_date"], 70_001), (["listen_date", "listen_hour"], None)):
        one = partials.listeners_estimated(whole, keys).collect()
        assert sorted(one) == sorted(partials.listeners_estimated(many, keys).collect())
        if exact:
            assert abs(one[0].approx_listeners - exact) <= 4 * partials.SKETCH_ERROR * exact


# --- the fact in buckets


def test_new_events_move_and_stored_ones_do_not(spark, database):
    load(spark, DAY_1, "2024-06-25")
    assert buckets_of(spark, TABLES.fact) == 4
    stored = spark.table(TABLES.fact).where("load_date != DATE'2024-06-26'")
    new = spark.createDataFrame(DAY_1[:5] + DAY_2, FACT).select(*schemas.STREAM_KEY)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        known = enrich.same_dates(stored, [dt.date(2024, 6, 25)])
        fresh = enrich.not_yet_stored(new, known)
        plan = executed(fresh)
        assert fresh.count() == len(DAY_2)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    final = plan.split("== Initial Plan ==")[0]
    assert "Bucketed: true" in final
    # One shuffle, of the new events.
    assert sum("Exchange hashpartitioning" in line for line in final.splitlines()) == 1
    stored_side = final[final.index("Scan parquet spark_catalog.kept.fact_streams") - 400 :]
    assert "Exchange" not in stored_side
    # The date is a partition filter that needs no job.
    assert "dynamicpruning" not in final and "listen_date" in final


def test_one_user_with_most_plays_is_spread_over_the_buckets(spark, database):
    plays = [play(1, "T1", f"2024-06-25 0{h}:{m:02d}:00") for h in range(5) for m in range(60)]
    load(spark, plays, "2024-06-25")
    at = F.input_file_name()
    sizes = spark.table(TABLES.fact).groupBy(at.alias("f")).count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 110


def test_files_of_a_history_grow_with_its_rows_not_with_dates_times_buckets(spark, database):
    plays = [play(u, "T1", f"2024-06-{d:02d} 00:0{u}:00") for u in range(5) for d in range(1, 21)]
    fact = spark.createDataFrame(plays, FACT).withColumns(
        {"listen_date": F.to_date("listen_time"), "listen_hour": F.hour("listen_time")}
    )
    write_fact(fact, TABLES.fact, "2024-06-25", rebalance=True, rows=4_000_000, dates=20)
    stored = spark.table(TABLES.fact)
    assert buckets_of(spark, TABLES.fact) == 0 and len(stored.inputFiles()) == 20
    # Events that are stored are still found.
    new = fact.select(*schemas.STREAM_KEY).unionByName(
        spark.createDataFrame(DAY_2, FACT).select(*schemas.STREAM_KEY)
    )
    known = enrich.same_dates(stored, fact.select("listen_date").distinct())
    assert enrich.not_yet_stored(new, known).count() == len(DAY_2)


def test_dates_that_fill_buckets_keep_them(spark, database):
    plays = [play(u, "T1", f"2024-06-{d:02d} 00:0{u}:00") for u in range(5) for d in range(1, 21)]
    fact = spark.createDataFrame(plays, FACT).withColumns(
        {"listen_date": F.to_date("listen_time"), "listen_hour": F.hour("listen_time")}
    )
    write_fact(fact, TABLES.fact, "2024-06-25", rebalance=True, rows=60_000_000, dates=20)
    assert buckets_of(spark, TABLES.fact) == 3


# --- lookups of the keys that occur


def test_lookup_rows_no_event_has_change_nothing(spark, rows):
    events = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, "c"), (9, "x"), (None, "n")], "user_id long, e string"
    )
    users = spark.range(8).select(F.col("id").alias("user_id"), F.lit("u").alias("name"))
    met = enrich.met(users, "user_id", key_counts(events, "user_id"))
    assert rows(met) == [(1, "u"), (2, "u")]
    for how in ("inner", "left_anti"):
        assert rows(lookup_join(events, met, "user_id", how)) == rows(
            lookup_join(events, users, "user_id", how)
        )


def test_the_daily_job_joins_what_its_events_meet(spark, tmp_path, monkeypatch):
    """A catalogue too large to broadcast, of which the day's events need three songs."""
    met, joined = enrich.met, []
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 10)
    monkeypatch.setattr(enrich, "met", lambda *x: joined.append(met(*x)) or joined[-1])
    songs = spark.range(40).selectExpr(
        "cast(id as int) id", "concat('T', id) track_id", "'a' artists", "'l' album_name",
        "'n' track_name", "1 popularity", "1 duration_ms", "0 explicit", "1D tempo", "'g' track_genre",
    )
    users = spark.range(1, 40).selectExpr(
        "id user_id", "'u' user_name", "20 user_age", "'c' user_country",
        "timestamp_ntz'2024-01-01 00:00:00' created_at",
    )
    streams = spark.range(30).selectExpr(
        "id % 3 + 1 user_id", "concat('T', id % 3) track_id",
        "timestamp'2024-06-25 00:00:00' + make_dt_interval(0, 0, cast(id as int)) listen_time",
    )
    spark.sql("CREATE DATABASE met")
    try:
        places = daily.Locations("", "", "", str(tmp_path / "audits"))
        report = daily.load(
            spark, songs, users, streams, places, "2024-06-25", tables=views.Tables("met")
        )
        assert report.overall_total == 30 and (report.missing_users, report.missing_songs) == (0, 0)
        assert spark.table("met.dim_songs").count() == 40 and len(joined) == 2
    finally:
        spark.sql("DROP DATABASE met CASCADE")


def test_two_load_days_derive_their_events_once(spark, rows):
    i = queries.inputs(spark, "/root/testdata/sf0.001")
    first, second = queries._two_days(i)
    part = F.pmod(F.xxhash64("user_id", "track_id", "listen_time"), F.lit(3))
    for found, expected in ((first, part < 2), (second, part > 0)):
        assert "props" not in found._jdf.queryExecution().executedPlan().toString()
        assert found.schema == i.streams_dirty.schema
        assert rows(found) == rows(i.streams_dirty.where(expected))


# --- the manifest


def lines(path, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(r) + "\n" for r in records))


def listen(user, time):
    return {"user_id": user, "track_id": "T", "listen_time": time}


@pytest.fixture
def land(spark, tmp_path):
    def landed(**more):
        records = spark.readStream.text(str(tmp_path / "source"))
        hour = F.to_timestamp(F.get_json_object("value", "$.listen_time"))
        land_batches(
            records, str(tmp_path / "topic"), str(tmp_path / "checkpoint"), hour, **more
        ).awaitTermination()

    return landed


def users(spark, root, day):
    found = read_hour_partitions(spark, root, day, schemas.STREAMS, True, "manifest")
    return sorted((r.user_id, r.day, r.hour) for r in found.collect())


@pytest.mark.parametrize("more", [{}, {"files_per_hour": 2}])
def test_days_are_read_by_their_manifests(spark, tmp_path, land, more):
    root = str(tmp_path / "topic")
    lines(tmp_path / "source/1.json", [listen(1, "2025-06-20 09:59:59"),
                                       listen(2, "2025-06-20 10:00:00")])
    land(**more)
    lines(tmp_path / "source/2.json", [listen(3, "2025-06-20 09:00:00"),
                                       listen(4, "2025-06-21 00:00:00")])
    land(**more)
    land(**more)
    assert users(spark, root, "2025-06-20") == [(1, 20, 9), (2, 20, 10), (3, 20, 9)]
    assert users(spark, root, "2025-06-21") == [(4, 21, 0)]
    assert users(spark, root, "2025-06-22") == [] and len(users(spark, root, None)) == 4
    # Torn files: of a batch without a manifest, beside the batches, and in a listed folder.
    hour = tmp_path / "topic/year=2025/month=06/day=20/hour=09"
    for torn in ("batch=7/part-torn.txt", "part-torn.txt", "batch=0/part-torn.txt"):
        lines(hour / torn, ["torn"])
        (hour / torn).write_text('{"user_id": 9, "tra')
    assert users(spark, root, "2025-06-20") == [(1, 20, 9), (2, 20, 10), (3, 20, 9)]


def test_a_day_opens_its_own_manifest_only(spark, tmp_path, land):
    root = str(tmp_path / "topic")
    lines(tmp_path / "source/1.json", [listen(n, f"2025-06-{20 + n} 09:00:00") for n in range(5)])
    land()
    for other in (tmp_path / "topic" / MANIFEST).glob("date=*"):
        if other.name != "date=2025-06-22":
            for file in other.rglob("part-*.json"):
                file.write_text("not a list")
    assert users(spark, root, "2025-06-22") == [(2, 22, 9)]
    assert len(list((tmp_path / "topic" / MANIFEST).glob("date=*"))) == 5


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path, land):
    root = str(tmp_path / "topic")
    lines(tmp_path / "source/1.json", [listen(1, "2025-06-20 09:59:59")])
    land()
    # The driver was lost before the batch was marked as done.
    for done in (tmp_path / "checkpoint/commits").iterdir():
        done.unlink()
    land()
    assert users(spark, root, "2025-06-20") == [(1, 20, 9)]


def test_an_unknown_listing_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        files.hour_records(spark, str(tmp_path), "2025-06-20", "guess")


# --- one parse, counts beside the work, ordinals


def test_further_columns_come_from_what_was_staged(spark, tmp_path):
    lines(tmp_path / "in/1.json", [
        listen(1, "2025-06-20 09:00:00") | {"device": "phone", "n": {"a": 1}},
        listen(None, None) | {"volume": 3}, listen(2, "2025-06-20 09:00:00") | {"volume": 2.5}])
    text = files.text_records(spark, str(tmp_path / "in"))
    # A further scan of the text would show in the plan of what is returned.
    staged, rows, missing = stage_records(text, schemas.STREAMS, fresh_folder(spark, "s"))
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "Scan text" not in plan and "FileScan parquet" in plan
    assert rows == 3
    assert missing == {"user_id": 1, "track_id": 0, "listen_time": 1, "device": 2, "n": 2,
                       "volume": 1}
    assert {r.user_id: (r.device, r.volume, r.n and r.n.a) for r in staged.collect()} == {
        1: ("phone", None, 1), None: (None, 3.0, None), 2: (None, 2.5, None)
    }


def test_texts_are_scanned_by_one_job(spark, tmp_path):
    """With the text gone, what was staged from it still answers."""
    lines(tmp_path / "in/1.json", [listen(1, "2025-06-20 09:00:00") | {"device": "phone"}])
    text = files.text_records(spark, str(tmp_path / "in"))
    staged, *_ = stage_records(text, schemas.STREAMS, fresh_folder(spark, "s"))
    (tmp_path / "in/1.json").unlink()
    assert staged.first().device == "phone"


def test_nothing_beyond_the_schema_and_nothing_at_all(spark, tmp_path):
    lines(tmp_path / "in/1.json", [listen(1, None), listen(2, None)])
    text = files.text_records(spark, str(tmp_path / "in"))
    staged, rows, missing = stage_records(text, schemas.STREAMS, fresh_folder(spark, "s"))
    assert staged.columns == schemas.STREAMS.names and rows == 2
    assert missing == {"user_id": 0, "track_id": 0, "listen_time": 2}
    none = text.where("value = ''")
    staged, rows, missing = stage_records(none, schemas.STREAMS, fresh_folder(spark, "s"))
    assert staged.count() == rows == 0 and set(missing.values()) == {0}


def test_counts_beside_the_work_are_the_profile(spark):
    df = spark.createDataFrame(
        [(1, None, float("nan")), (None, "x", 1.0), (2, "y", None)] * 50,
        "`a.b` int, rows string, c double",
    ).repartition(7)
    counted = Counted(df)
    counted.df.write.format("noop").mode("overwrite").save()
    assert counted.rows == 150
    assert counted.missing == dict(map(tuple, null_profile(df).collect()))
    empty = Counted(df.limit(0))
    empty.df.write.format("noop").mode("overwrite").save()
    assert empty.rows == 0 and set(empty.missing.values()) == {0}


def test_ordinals_do_not_depend_on_splits(spark, tmp_path):
    path = str(tmp_path / "o")
    spark.range(20_000).repartition(5).write.option("parquet.block.size", "4096").parquet(path)
    numbered = with_ordinal(spark.read.parquet(path).withColumn("twice", F.col("id") * 2))
    assert "to-number" not in numbered._jdf.queryExecution().executedPlan().toString()
    seen = set()
    for size in ("2000", "30000", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            found = numbered.select("*").collect()
            seen.add(tuple(sorted((r.ordinal, r.id) for r in found)))
            # A frame planned anew numbers alike.
            again = with_ordinal(spark.read.parquet(path)).collect()
            seen.add(tuple(sorted((r.ordinal, r.id) for r in again)))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(seen) == 1
    assert [n for n, _ in seen.pop()] == list(range(20_000))


@pytest.mark.parametrize("build", [
    lambda df: df.where("id % 3 = 0"),
    lambda df: df.select("id", F.explode(F.array(F.lit(1), F.lit(2))).alias("n")),
    lambda df: df.unionByName(df),
    lambda df: df.groupBy((F.col("id") % 7).alias("id")).count(),
])
def test_other_frames_are_staged_before_they_are_numbered(spark, tmp_path, build):
    path = str(tmp_path / "o")
    spark.range(100).repartition(3).write.parquet(path)
    df = build(spark.read.parquet(path))
    numbered = with_ordinal(df)
    assert sorted(r.ordinal for r in numbered.collect()) == list(range(df.count()))
    assert sorted(r.id for r in numbered.collect()) == sorted(r.id for r in df.collect())
