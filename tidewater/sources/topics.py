"""Topics of string records, from a Kafka cluster or a folder of Parquet files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.schemas import RECORD_ID, TOPIC_ROW


def kafka_source_options(
    bootstrap: str,
    topic: str,
    group: str | None = None,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source. Progress itself lives in the checkpoint."""
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if group:
        options["kafka.group.id"] = group
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def starting_offsets_json(offsets: DataFrame, topic: str, group: str, partitions: int | None = None) -> str:
    """Resume position for ``startingOffsets`` from a stored offset table.

    The table holds ``group_id, topic, partition_id, topic_offset``; the rows of
    one topic and group are as many as the topic has partitions. Kafka wants every
    partition named: given the topic's number of ``partitions``, those that the
    table lacks start at the latest offset.
    """
    rows = (
        offsets.where((F.col("topic") == topic) & (F.col("group_id") == group))
        .groupBy("partition_id")
        .agg(F.max("topic_offset").alias("topic_offset"))
        .collect()
    )
    if not rows:
        return "latest"
    at = {str(p): -1 for p in range(partitions or 0)} | {str(r.partition_id): int(r.topic_offset) for r in rows}
    return json.dumps({topic: at}, sort_keys=True)


def read_topic(
    spark: SparkSession,
    topic: str,
    *,
    bootstrap: str | None = None,
    path: str | None = None,
    group: str | None = None,
    starting_offsets: str = "latest",
    max_files_per_trigger: int | None = None,
    max_offsets_per_trigger: int | None = None,
    once_within: str | None = None,
) -> DataFrame:
    """Stream of ``key, value, timestamp`` records of one topic.

    With ``once_within``, a length of time, a record that its writer sent again within so long
    of event time comes once, known by its record id; ids are kept for as long. Records further
    behind the newest than that may be left out, and so the result has a watermark. All records
    of the topic must carry ids, as those of ``write_topic_batch`` do.
    """
    if bootstrap:
        options = kafka_source_options(bootstrap, topic, group, starting_offsets, max_offsets_per_trigger)
        if once_within:
            options["includeHeaders"] = "true"
        records = spark.readStream.format("kafka").options(**options).load()
        if once_within:
            mine = F.filter("headers", lambda h: h["key"] == RECORD_ID)
            records = records.withColumn(RECORD_ID, F.get(mine, 0)["value"].cast("string"))
    elif path:
        reader = spark.readStream.schema(f"{TOPIC_ROW}, {RECORD_ID} string" if once_within else TOPIC_ROW)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        records = reader.parquet(path).where(F.col("topic") == topic)
    else:
        raise ValueError("name a Kafka bootstrap address or a folder")
    if once_within:
        records = records.withWatermark("timestamp", once_within).dropDuplicatesWithinWatermark([RECORD_ID])
    return records.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "timestamp"
    )
