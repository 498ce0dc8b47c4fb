from __future__ import annotations

from checks.fixtures import map_events


def test_track_ids_from_any_props(spark):
    props = ['{"k": 76}', '{"k":5}', '{"k": "a"}', '{"j": 1, "k": 2}', '{"j": 1}', None, '{"k": -3}']
    df = spark.createDataFrame([(1, p) for p in props], "user_id BIGINT, props STRING").selectExpr(
        "user_id", "props", "1 AS event_id", "current_timestamp() AS ts"
    )
    tracks = [r.track_id for r in map_events(df).collect()]
    assert sorted(t or "" for t in tracks) == ["", "", "T-3", "T2", "T5", "T76", "Ta"]
