"""The ingestion steps up to the database and the broker, which are replaced by capture."""

from __future__ import annotations

import json

import pytest

from earshot import schemas
from earshot.plans import ingest
from earshot.sources.records import parse_records


@pytest.fixture
def inputs(tmp_path):
    songs, users = tmp_path / "songs.csv", tmp_path / "users.csv"
    names = schemas.SONGS.names
    row = {"id": "0", "track_id": "T0", "explicit": "False", "tempo": "", "track_genre": "pop"}
    songs.write_text(",".join(names) + "\n" + ",".join(row.get(n, "1") for n in names) + "\n")
    users.write_text("user_id,user_name,user_age,user_country,created_at\n1,Ann,30,NO,2024-06-20\n")
    streams = []
    for i in range(3):
        path = tmp_path / f"streams{i + 1}.csv"
        path.write_text("user_id,track_id,listen_time\n"
                        + "".join(f"{i},T{n},2024-06-25 0{n}:00:00\n" for n in range(4)))
        streams.append(str(path))
    return str(songs), str(users), streams


def test_database_tables(spark, inputs, monkeypatch):
    written = {}
    monkeypatch.setattr(ingest, "write_jdbc", lambda df, url, table, options, long_text=():
                        written.update({table: (df, long_text, dict(options))}))
    ingest.load_database(spark, *inputs[:2], "jdbc:somewhere", {"user": "u"})
    songs, long_text, options = written["songs"]
    assert dict(songs.dtypes)["explicit"] == "boolean" and long_text == ingest.LONG_TEXT
    assert options == {"user": "u"}
    song = songs.first()
    assert (song.id, song.explicit, song.tempo, song.track_genre) == (0, False, None, "pop")
    assert tuple(written["users"][0].first()) == (1, "Ann", 30, "NO", "2024-06-20")


def test_database_export(spark, tmp_path, monkeypatch):
    frames = {
        "songs": spark.createDataFrame([(1, True)], "id INT, explicit BOOLEAN"),
        "users": spark.createDataFrame([(1, None)], "user_id INT, user_name STRING"),
    }
    asked = []

    def read(spark, url, table, options, column):
        asked.append((table, column))
        return frames[table]

    monkeypatch.setattr(ingest, "read_jdbc", read)
    ingest.export_database(spark, "jdbc:x", {}, str(tmp_path / "s"), str(tmp_path / "u"))
    assert asked == [("songs", "id"), ("users", "user_id")]
    text = "".join(p.read_text() for p in (tmp_path / "u").glob("part-*"))
    assert json.loads(text) == {"user_id": 1, "user_name": None}


def test_published_records(spark, inputs, monkeypatch):
    sent = {}
    monkeypatch.setattr(ingest, "write_kafka", lambda records, servers, topic, options:
                        sent.update(records=records, topic=topic))
    ingest.publish_streams(spark, inputs[2], "broker:9092", "streams_play")
    records = sent["records"].collect()
    assert sorted(int(r.key) for r in records) == list(range(12))
    assert '{"user_id":2,"track_id":"T3","listen_time":"2024-06-25 03:00:00"}' in [
        r.value for r in records
    ]
    assert parse_records(sent["records"], schemas.STREAMS).count() == 12


def test_topic_lands_by_record_time(spark, tmp_path, monkeypatch):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.json").write_text(
        '{"timestamp": "2025-06-20T09:30:00", "value": "{\\"user_id\\":\\n1}"}\n'
    )
    monkeypatch.setattr(
        ingest, "read_kafka_records",
        lambda spark, *_: spark.readStream.schema("timestamp TIMESTAMP, value STRING")
        .json(str(source)),
    )
    ingest.land_topic(
        spark, "broker:9092", "t", str(tmp_path / "out"), str(tmp_path / "c")
    ).awaitTermination()
    files = list((tmp_path / "out/year=2025/month=06/day=20/hour=09").glob("part-*"))
    assert [f.read_text() for f in files] == ['{"user_id": 1}\n']
