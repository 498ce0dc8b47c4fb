"""Files, tables, records and options."""

from __future__ import annotations

import datetime as dt
import json
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot import schemas
from earshot.operators.ordinal import with_ordinal
from earshot.plans import kpi, views
from earshot.sinks import files as out
from earshot.sinks import jdbc, kafka, tables
from earshot.sources.files import read_csv_table, read_hour_partitions, read_jsonl
from earshot.sources.records import parse_records

NINE = dt.datetime(2025, 6, 20, 9)


def write(path: Path, text: str) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


# --- JSON lines


def test_jsonl_skips_blank_lines_and_keeps_nulls(spark, tmp_path):
    path = write(tmp_path / "s.json", '{"user_id": 1, "track_id": "T1", "listen_time": null}\n\n'
                 '  \n{"user_id": 2.0, "track_id": null, "listen_time": "2025-06-20 09:00:00"}\n')
    found = read_jsonl(spark, path, schemas.STREAMS)
    assert found.schema == schemas.STREAMS
    assert sorted(map(tuple, found.collect())) == [(1, "T1", None), (2, None, NINE)]


def test_malformed_json_fails(spark, tmp_path):
    path = write(tmp_path / "s.json", '{"user_id": 1}\n{"user_id": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_jsonl(spark, path, schemas.STREAMS).collect()


def test_json_array_file(spark, tmp_path):
    path = write(tmp_path / "u.json", json.dumps(
        [{"user_id": i, "created_at": "2024-06-20T00:00:00"} for i in range(3)], indent=1))
    found = read_jsonl(spark, path, schemas.USERS, multiline=True)
    assert found.count() == 3
    assert found.first().created_at == dt.datetime(2024, 6, 20)


def test_flags_read_from_numbers_and_words(spark, tmp_path):
    path = write(tmp_path / "g.json", '{"id": 1, "explicit": true}\n{"id": 2, "explicit": 0}\n')
    found = read_jsonl(spark, path, schemas.SONGS).select("id", "explicit")
    assert sorted(map(tuple, found.collect())) == [(1, 1), (2, 0)]


def test_jsonl_export_spells_out_nulls_and_keeps_microseconds(spark, tmp_path):
    time = dt.datetime(2025, 6, 20, 9, 0, 0, 123456)
    df = spark.createDataFrame([(1, None, time)], schemas.STREAMS)
    out.write_jsonl(df, str(tmp_path / "o"))
    text = "".join(p.read_text() for p in (tmp_path / "o").glob("part-*"))
    assert json.loads(text) == {
        "user_id": 1, "track_id": None, "listen_time": "2025-06-20 09:00:00.123456",
    }
    assert tuple(read_jsonl(spark, str(tmp_path / "o"), schemas.STREAMS).first()) == (1, None, time)


# --- CSV


def test_csv_types_and_missing_markers(spark, tmp_path):
    path = write(tmp_path / "u.csv", "user_id,user_name,user_age,user_country,created_at\n"
                 '1,"Ann, ""A""",12.0,NA,2024-06-20\n2,,,"",\n')
    found = read_csv_table(spark, path, schemas.USERS)
    assert found.schema == schemas.USERS
    assert sorted(map(tuple, found.collect())) == [
        (1, 'Ann, "A"', 12, None, dt.datetime(2024, 6, 20)),
        (2, None, None, None, None),
    ]


def test_several_csv_files_make_one_table(spark, tmp_path):
    header = "user_id,track_id,listen_time\n"
    paths = [write(tmp_path / f"s{i}.csv", f"{header}{i},T,2025-06-20 09:00:00\n") for i in (1, 2, 3)]
    assert read_csv_table(spark, paths, schemas.STREAMS).count() == 3


def test_csv_with_another_header_fails(spark, tmp_path):
    path = write(tmp_path / "s.csv", "track_id,user_id,listen_time\nT,1,2025-06-20 09:00:00\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_table(spark, path, schemas.STREAMS).collect()


def test_csv_line_breaks_in_quotes(spark, tmp_path):
    path = write(tmp_path / "s.csv", 'user_id,track_id,listen_time\n1,"a\nb",2025-06-20 09:00:00\n')
    found = read_csv_table(spark, path, schemas.STREAMS, quoted_newlines=True)
    assert found.first().track_id == "a\nb"


def test_csv_export_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "x", y', NINE), (2, None, None)], schemas.STREAMS)
    out.write_csv(df, str(tmp_path / "c"))
    back = read_csv_table(spark, str(tmp_path / "c"), schemas.STREAMS)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_audit_is_written_only_with_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, "T", NINE)], schemas.STREAMS)
    assert out.write_audit(df, str(tmp_path / "some")) and (tmp_path / "some").exists()
    assert not out.write_audit(df.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


# --- hour partitions


@pytest.fixture
def landing(tmp_path):
    for day, hour in ((19, 23), (20, 0), (20, 9)):
        write(tmp_path / f"year=2025/month=06/day={day}/hour={hour:02d}/e.json",
              f'{{"user_id": {hour}, "track_id": "T", "listen_time": "2025-06-{day} 09:00:00"}}\n')
    return str(tmp_path)


@pytest.mark.parametrize("listed_by", ["folder", "log"])
def test_one_landing_day(spark, landing, listed_by):
    found = read_hour_partitions(
        spark, landing, "2025-06-20", schemas.STREAMS, True, listed_by
    )
    assert sorted((r.user_id, r.day, r.hour) for r in found.collect()) == [(0, 20, 0), (9, 20, 9)]
    bare = read_hour_partitions(spark, landing, dt.date(2025, 6, 19), schemas.STREAMS)
    assert bare.schema == schemas.STREAMS and bare.count() == 1


def test_only_the_days_files_are_listed(spark, landing):
    found = read_hour_partitions(spark, landing, "2025-06-20", schemas.STREAMS)
    assert len(found.inputFiles()) == 2
    assert read_hour_partitions(spark, landing, None, schemas.STREAMS).count() == 3


# --- tables


def fact(spark, *listens):
    df = spark.createDataFrame(list(listens), "user_id INT, listen_time TIMESTAMP")
    return df.withColumn("listen_date", F.to_date("listen_time"))


def test_fact_reruns_replace_their_load_day_only(spark, tmp_path):
    end = dt.datetime(9999, 12, 31)
    table, path = "fact_rerun", str(tmp_path / "fact")
    tables.write_fact(fact(spark, (1, NINE), (2, end)), table, "2025-06-20", path)
    tables.write_fact(fact(spark, (3, NINE), (4, end)), table, "2025-06-21", path)
    assert spark.table(table).count() == 4
    tables.write_fact(fact(spark, (5, NINE)), table, "2025-06-21", path)
    assert sorted(r.user_id for r in spark.table(table).collect()) == [1, 2, 5]
    assert spark.table(table).columns == ["user_id", "listen_time", "load_date", "listen_date"]
    spark.sql(f"DROP TABLE {table}")


def test_fact_partitions_prune(spark, tmp_path):
    table = "fact_pruned"
    tables.write_fact(fact(spark, (1, NINE)), table, "2025-06-20", str(tmp_path / "f"), True)
    df = spark.table(table).where("listen_date = DATE'2025-06-20'").select("user_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(listen_date" in plan
    assert "ReadSchema: struct<user_id:int>" in plan
    spark.sql(f"DROP TABLE {table}")


def test_a_date_filter_on_the_hourly_view_prunes_both_scans(spark, tmp_path):
    plays = spark.createDataFrame(
        [(1, "g", "a", 20, day, 9) for day in (NINE.date(), NINE.date() + dt.timedelta(1))],
        "user_id INT, track_genre STRING, artists STRING, user_age INT, listen_date DATE,"
        "listen_hour INT",
    )
    tables.write_fact(plays, "fact_hours", "2025-06-21", str(tmp_path / "f"))
    text = views.VIEWS["view_hourly_kpi"].format(fact="fact_hours")
    for hourly in (spark.sql(text), kpi.hourly_kpi(spark.table("fact_hours"))):
        one_day = hourly.where("listen_date = DATE'2025-06-20'")
        plan = one_day._jdf.queryExecution().executedPlan().toString()
        pruned = re.findall(r"PartitionFilters: \[[^]]*listen_date#\d+ = 2025-06-20", plan)
        assert len(pruned) == plan.count("FileScan parquet") == 2
        assert one_day.count() == 1
    spark.sql("DROP TABLE fact_hours")


def test_overwrite_mode_of_the_session_is_kept(spark, tmp_path):
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        tables.write_fact(fact(spark, (1, NINE)), "fact_mode", "2025-06-20", str(tmp_path / "f"))
        assert spark.conf.get(name) == "dynamic"
    finally:
        spark.conf.set(name, before)
        spark.sql("DROP TABLE IF EXISTS fact_mode")


# --- database options


def test_column_types():
    assert jdbc.jdbc_column_types(schemas.USERS) == {
        "user_id": "INT", "user_name": "VARCHAR(255)", "user_age": "INT",
        "user_country": "VARCHAR(255)", "created_at": "TEXT",
    }
    mixed = T.StructType().add("a", T.DoubleType()).add("b", T.BooleanType()).add("c", T.LongType())
    assert list(jdbc.jdbc_column_types(mixed).values()) == ["DOUBLE", "BOOLEAN", "INT"]


def test_writer_options_parse_as_spark_types():
    options = jdbc.jdbc_options(schemas.SONGS, long_text=("artists", "album_name", "track_name"))
    assert options["batchsize"] == "1000"
    declared = T.StructType.fromDDL(options["createTableColumnTypes"])
    assert "artists" not in declared.names and "key" in declared.names
    assert declared["track_id"].dataType == T.VarcharType(255)
    assert "createTableColumnTypes" not in jdbc.jdbc_options(T.StructType().add("t", T.LongType()))


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), "x"), (1.0, "y")], "d DOUBLE, s STRING")
    assert sorted(map(tuple, jdbc.nan_to_null(df).collect()), key=str) == [(1.0, "y"), (None, "x")]


# --- records


def test_records_and_back(spark):
    df = spark.createDataFrame(
        [(1, "T1", "2025-06-20 09:00:00"), (2, None, None)],
        "user_id INT, track_id STRING, listen_time STRING",
    ).repartition(2)
    records = kafka.to_kafka_records(df)
    assert records.schema.simpleString() == "struct<key:string,value:string>"
    assert records.select("key").distinct().count() == 2
    assert '{"user_id":2,"track_id":null,"listen_time":null}' in [r.value for r in records.collect()]
    back = parse_records(records, schemas.STREAMS)
    assert back.schema == schemas.STREAMS
    assert sorted(map(tuple, back.collect())) == [(1, "T1", NINE), (2, None, None)]


def test_ordinals_are_dense(spark, tmp_path):
    spark.range(1000).repartition(7).write.parquet(str(tmp_path / "o"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        df = spark.read.parquet(str(tmp_path / "o")).withColumn("twice", F.col("id") * 2)
        assert df.rdd.getNumPartitions() > 1
        numbered = with_ordinal(df).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r.ordinal for r in numbered) == list(range(1000))
    assert sorted(r.id for r in numbered) == list(range(1000))
    plan = with_ordinal(df)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    one = with_ordinal(spark.createDataFrame([("x",)], "a STRING"))
    assert tuple(kafka.to_kafka_records(one, "ordinal").first()) == ("0", '{"a":"x"}')


def test_bare_nan_is_missing(spark, tmp_path):
    record = '{"user_id": NaN, "track_id": NaN, "listen_time": NaN}'
    df = spark.createDataFrame([(record,)], "value STRING")
    assert tuple(parse_records(df, schemas.STREAMS).first()) == (None, None, None)
    titled = '{"user_id": 1, "track_id": "NaN"}'
    write(tmp_path / "year=2025/month=06/day=20/hour=00/e.json", f"{record}\n{titled}\n")
    landed = read_hour_partitions(spark, str(tmp_path), "2025-06-20", schemas.STREAMS)
    assert sorted(landed.collect(), key=str) == [(1, "NaN", None), (None, None, None)]


def test_landing_skips_blank_lines_and_fails_on_malformed_ones(spark, tmp_path):
    file = tmp_path / "year=2025/month=06/day=20/hour=00/e.json"
    write(file, '\n{"user_id": 1}\n   \n{"user_id": 2}\n')
    landed = read_hour_partitions(spark, str(tmp_path), "2025-06-20", schemas.STREAMS)
    assert sorted(r.user_id for r in landed.collect()) == [1, 2]
    write(file, '{"user_id": 1}\n{"user_id": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_hour_partitions(spark, str(tmp_path), "2025-06-20", schemas.STREAMS).collect()


def test_malformed_record_fails(spark):
    with pytest.raises(Exception, match="(?i)malformed"):
        parse_records(spark.createDataFrame([("{",)], "value STRING"), schemas.STREAMS).collect()
