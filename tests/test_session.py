from __future__ import annotations

from types import SimpleNamespace

import pytest

from earshot import session

_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_shuffles_are_sized_by_rows(spark):
    before = spark.conf.get(_INITIAL, None)
    try:
        for rows, partitions in ((0, 8), (10**6, 8), (10**9, 500), (10**12, 50_000)):
            session.size_shuffles(spark, rows)
            assert spark.conf.get(_INITIAL) == str(partitions)
    finally:
        if before is None:
            spark.conf.unset(_INITIAL)
        else:
            spark.conf.set(_INITIAL, before)


def test_staged_frames_keep_rows_and_schema(spark):
    folder = session.fresh_folder(spark, "test-stage")
    df = spark.range(10).selectExpr("id", "CAST(id AS STRING) AS s", "TIMESTAMP_NTZ'2024-01-01' AS t")
    staged = session.stage(df, folder)
    assert staged.dtypes == df.dtypes
    assert sorted(staged.collect()) == sorted(df.collect())
    assert folder.startswith(session.shared_folder(spark))


def test_no_shared_folder_is_guessed(monkeypatch):
    monkeypatch.setattr(session, "_own_folder", [])
    unnamed = SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: default),
        sparkContext=SimpleNamespace(master="yarn"),
    )
    session.name_own_folder(unnamed)
    with pytest.raises(ValueError):
        session.fresh_folder(unnamed, "x")
    unnamed.sparkContext.master = "local[2]"
    session.name_own_folder(unnamed)
    assert session.fresh_folder(unnamed, "x") != session.fresh_folder(unnamed, "x")


def test_steps_run_together_and_all_end_before_a_failure(spark):
    ended = []

    def step(n, fails=False):
        def run():
            found = spark.range(n).count()
            if fails:
                raise ValueError(f"step {n}")
            ended.append(n)
            return found

        return run

    assert session.together(spark, step(3), step(1), step(2)) == [3, 1, 2]
    assert sorted(ended) == [1, 2, 3]
    with pytest.raises(ValueError, match="step 5"):
        session.together(spark, step(5, fails=True), step(4), step(6))
    assert sorted(ended) == [1, 2, 3, 4, 6]
