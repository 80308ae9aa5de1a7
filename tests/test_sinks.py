"""Batch-addressed tables, upserts, and the option builders of remote systems."""

import pytest

from conftest import rows
from pyspark.sql import functions as F
from tidewater.operators import dims
from tidewater.sinks import jdbc, tables, topics
from tidewater.sources import tables as stored
from tidewater.sources import topics as source_topics

ROW = "id string, name string, at int"


def versions(spark, data):
    return spark.createDataFrame(data, ROW)


def test_a_repeated_batch_changes_nothing(spark, folder):
    for _ in range(2):
        tables.write_once(versions(spark, [("a", "x", 1), ("b", "y", 2)]), folder, 0, ["at"])
        tables.write_once(versions(spark, [("a", "z", 3)]), folder, 1, ["at"])
    assert rows(stored.read_table(spark, folder), "id", "name", "batch_id") == [("a", "x", 0), ("a", "z", 1), ("b", "y", 0)]


def test_a_changed_batch_replaces_all_its_partitions(spark, folder):
    tables.write_once(versions(spark, [("a", "x", 1), ("b", "y", 2)]), folder, 0, ["at"])
    tables.write_once(versions(spark, [("a", "x", 1)]), folder, 0, ["at"])
    assert rows(stored.read_table(spark, folder), "id") == [("a",)]


def test_upsert_keeps_the_latest(spark, folder):
    tables.upsert_by_key(versions(spark, [("a", "old", 1), ("a", "new", 2), ("b", "b", 1)]), folder, 0, ["id"], ["at"])
    tables.upsert_by_key(versions(spark, [("a", "newest", 1)]), folder, 1, ["id"], ["at"])
    assert rows(tables.read_latest(spark, folder, ["id"], ROW)) == [("a", "newest", 1), ("b", "b", 1)]
    before = tables.read_latest(spark, folder, ["id"], ROW, before_batch=1)
    assert rows(before) == [("a", "new", 2), ("b", "b", 1)]
    tables.compact(spark, folder, f"{folder}-compact", ["id"], ROW)
    assert rows(tables.read_latest(spark, f"{folder}-compact", ["id"], ROW)) == [("a", "newest", 1), ("b", "b", 1)]


def test_runs_number_their_own_batches(spark, folder):
    for run, batch, at in (("a", 0, 1), ("a", 1, 3), ("b", 0, 2), ("b", 0, 2)):  # the last repeats a batch
        tables.upsert_by_key(versions(spark, [("k", run, at), (run, run, at)]), folder, batch, ["id"], ["at"], run=run)
    every = stored.read_table(spark, folder)
    assert every.count() == 6
    assert rows(tables.before(every, 1, "a"), "id", "run") == [("a", "a"), ("b", "b"), ("k", "a"), ("k", "b")]
    # Between runs the change time decides, not the batch number.
    assert rows(tables.read_latest(spark, folder, ["id"], ROW, ["at"])) == [("a", "a", 3), ("b", "b", 2), ("k", "a", 3)]


def test_absent_table_reads_empty_with_a_schema_only(spark, folder):
    assert stored.read_table(spark, f"{folder}/none", ROW).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        stored.read_table(spark, f"{folder}/none")


def test_day_reads_prune_partitions(spark, folder):
    days = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03")], "id int, dt string")
    tables.write_once(days, folder, 0, ["dt"])
    assert rows(stored.read_days(spark, folder, "2024-01-02"), "id") == [(2,)]
    span = stored.read_days(spark, folder, "2024-01-01", "2024-01-02")
    assert rows(span, "id") == [(1,), (2,)]
    plan = span._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_archive(spark, folder):
    logs = spark.createDataFrame([("{}", "2024-01-01"), ("{1}", "2024-01-02")], "value string, dt string")
    tables.archive_raw(logs, folder, 0)
    assert rows(spark.read.text(f"{folder}/batch_id=0/dt=2024-01-02"), "value") == [("{1}",)]


def test_dimension_deletes(spark):
    changes = spark.createDataFrame([("a", "insert", 1), ("a", "delete", 2), ("b", "insert", 1)], "id string, type string, at int")
    assert rows(dims.build_dim(changes, "id", ["at"]), "id", "type") == [("a", "delete"), ("b", "insert")]
    assert rows(dims.build_dim(changes, "id", ["at"], "type"), "id") == [("b",)]


def test_topic_batch(spark, folder):
    df = spark.createDataFrame([(1, "x"), (2, None)], "id int, name string")
    topics.write_topic_batch(topics.to_records(df, "T", "id", F.lit("2024-01-01")), 4, job="j", path=folder)
    assert rows(stored.read_table(spark, folder), "key", "value", "topic", "batch_id") == [
        ("1", '{"id":1,"name":"x"}', "T", 4), ("2", '{"id":2}', "T", 4),
    ]


def test_two_jobs_share_a_folder(spark, folder):
    for name in ("A", "B", "A"):  # the last repeats a batch
        df = spark.createDataFrame([(1,)], "id int")
        topics.write_topic_batch(topics.to_records(df, name, None, F.lit("2024-01-01")), 0, job=name, path=folder)
    assert rows(stored.read_table(spark, folder), "topic", "job", "batch_id") == [("A", "A", 0), ("B", "B", 0)]


def test_kafka_options():
    assert source_topics.kafka_source_options("h:9092", "t", "g", "earliest", 5) == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": "earliest",
        "kafka.group.id": "g", "maxOffsetsPerTrigger": "5",
    }
    assert source_topics.kafka_source_options("h:9092", "t")["startingOffsets"] == "latest"
    assert topics.kafka_sink_options("h:9092")["kafka.enable.idempotence"] == "true"


def test_stored_offsets(spark):
    offsets = spark.createDataFrame(
        [("g", "t", 0, 5), ("g", "t", 0, 7), ("g", "t", 1, 3), ("other", "t", 0, 99)],
        "group_id string, topic string, partition_id int, topic_offset bigint",
    )
    assert source_topics.starting_offsets_json(offsets, "t", "g") == '{"t": {"0": 7, "1": 3}}'
    assert source_topics.starting_offsets_json(offsets, "t", "g", 3) == '{"t": {"0": 7, "1": 3, "2": -1}}'
    assert source_topics.starting_offsets_json(offsets, "u", "g") == "latest"


def test_a_topic_needs_an_address(spark):
    with pytest.raises(ValueError):
        source_topics.read_topic(spark, "t")


def test_jdbc_options():
    assert jdbc.jdbc_write_options("jdbc:x", "t", driver="d") == {
        "url": "jdbc:x", "dbtable": "t", "batchsize": "100", "isolationLevel": "NONE", "driver": "d",
    }
    assert stored.jdbc_query_options("jdbc:x", "SELECT 1") == {"url": "jdbc:x", "query": "SELECT 1"}
