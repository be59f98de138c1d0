"""Sources and sinks that need no server: options, increments, landing, schemas."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterhouse.session import CHECKPOINT_CONF, work_folder, work_root
from meterhouse.sources import changefeed, files, jdbc, tables


def test_work_folder_follows_the_cluster_setting(spark):
    assert work_root(spark) == spark.conf.get(CHECKPOINT_CONF)
    assert work_folder(spark, "x") != work_folder(spark, "x")


def test_jdbc_read_is_split_by_key():
    options = jdbc.jdbc_options("jdbc:x", "users", "user_id", (1, 100), 8)
    assert options["partitionColumn"] == "user_id"
    assert (options["lowerBound"], options["upperBound"]) == ("1", "101")
    assert "partitionColumn" not in jdbc.jdbc_options("jdbc:x", "users", None, None, 8)
    assert "partitionColumn" not in jdbc.jdbc_options("jdbc:x", "users", "user_id", (None, None), 8)


def test_increment_statement():
    assert (
        jdbc.increment_query("query_log", "q_id", 500, 100, overlap=20)
        == "select * from query_log where q_id > 480 order by q_id limit 100"
    )


def test_pulls_drain_a_table(spark):
    df = spark.range(1, 26).withColumnRenamed("id", "k")
    mark, seen = 0, []
    while True:
        rows, new = jdbc.pull_increment(df, "k", mark, 10)
        if new == mark:
            break
        seen += [r["k"] for r in rows.collect()]
        mark = new
    assert seen == list(range(1, 26)) and mark == 25
    assert jdbc.pull_increment(df, "k", 25, 10)[1] == 25
    again, new = jdbc.pull_increment(df, "k", 25, 10, overlap=3)
    assert sorted(r["k"] for r in again.collect()) == [23, 24, 25] and new == 25


def test_watermarks_are_kept_per_table(spark, tmp_path):
    path = str(tmp_path / "marks")
    known = {"query_log": "q_id", "request_log": "log_id"}
    assert jdbc.load_watermarks(spark, path, known) == {"query_log": 0, "request_log": 0}
    jdbc.save_watermarks(spark, path, {"query_log": 7, "request_log": 9})
    assert jdbc.load_watermarks(spark, path, known) == {"query_log": 7, "request_log": 9}


def test_landed_lines(spark, tmp_path):
    df = spark.sql(
        "select 12 as id, timestamp'2024-01-02 03:04:05.678' as at, true as ok, "
        "cast('{\"a\": 1}' as binary) as doc, cast(null as string) as gone"
    )
    path = files.land_ndjson(df, str(tmp_path), "t", "id")
    assert path.endswith("/t/t_000000000012_000000000012")
    line = json.loads(spark.read.text(path).first()[0])
    assert line == {"id": 12, "at": "2024-01-02 03:04:05", "ok": 1, "doc": '{"a": 1}', "gone": None}
    files.land_ndjson(df, str(tmp_path), "t", "id")
    assert spark.read.json(path).count() == 1
    assert files.land_ndjson(df.limit(0), str(tmp_path), "t", "id") is None


def test_schema_modes(spark, tmp_path):
    landing, record = str(tmp_path / "in"), str(tmp_path / "schema")
    spark.sql("select 1 as id, 'x' as a").write.json(landing + "/1")
    first = files.recorded_schema(spark, landing, record)
    assert set(first.names) == {"id", "a"}
    spark.sql("select 2 as id, 'y' as a, 5 as b").write.json(landing + "/2")
    assert files.recorded_schema(spark, landing, record, files.RESCUE) == first
    with pytest.raises(files.SchemaWidened, match="b"):
        files.recorded_schema(spark, landing, record)
    second = files.recorded_schema(spark, landing, record)
    assert second.names == [*first.names, "b"]


def test_rescue_keeps_what_does_not_fit(spark):
    known = T.StructType.fromDDL("id int, a string")
    lines = spark.createDataFrame(
        [
            ('{"id":1,"a":"x"}',),
            ('{"id":2,"a":null,"b":{"c":[1,2]},"d":true}',),
            ('{"id":"seven","a":"x"}',),
            ('{"a":"only"}',),
        ],
        "value string",
    )
    rows = [tuple(r) for r in files.rescue_columns(lines, known).collect()]
    assert rows[0] == (1, "x", None)
    assert rows[1][:2] == (2, None) and json.loads(rows[1][2]) == {"b": '{"c":[1,2]}', "d": "true"}
    assert rows[2] == (None, "x", '{"id":"seven"}')
    assert rows[3] == (None, "only", None)


def test_kafka_options():
    plain = changefeed.kafka_options("host:9092", r"app\..*")
    assert plain["startingOffsets"] == "earliest" and plain["maxOffsetsPerTrigger"] == "50000"
    assert "kafka.sasl.jaas.config" not in plain
    secure = changefeed.kafka_options("host:9092", r"app\..*", "key", "secret")
    assert secure["kafka.security.protocol"] == "SASL_SSL"
    assert 'username="key" password="secret"' in secure["kafka.sasl.jaas.config"]


def test_snapshot_overwrites_schema_and_counts(spark, tmp_path):
    path = str(tmp_path / "snap")
    assert tables.write_snapshot(spark.range(5), path) == 5
    assert tables.write_snapshot(spark.sql("select 'a' as name"), path) == 1
    assert spark.read.parquet(path).columns == ["name"]


def test_snapshots_stack_up(spark, tmp_path):
    path = str(tmp_path / "stack")
    tables.append_snapshot(spark.range(2), path, "1")
    tables.append_snapshot(spark.range(3), path, "2")
    tables.append_snapshot(spark.range(4), path, "2")
    counts = spark.read.parquet(path).groupBy("snapshot").agg(F.count("*").alias("n")).collect()
    assert {r["snapshot"]: r["n"] for r in counts} == {1: 2, 2: 4}
