"""Records to topics: a Kafka cluster or a folder of Parquet files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidewater.schemas import RECORD_ID
from tidewater.sinks.tables import write_once


def to_records(
    df: DataFrame, topic: str | Column, key: str | None = None, timestamp: Column | None = None
) -> DataFrame:
    """Rows as ``key, value, timestamp, topic`` with the row as JSON in ``value``."""
    return df.select(
        (F.col(key).cast("string") if key else F.lit(None).cast("string")).alias("key"),
        F.to_json(F.struct("*")).alias("value"),
        (timestamp if timestamp is not None else F.current_timestamp()).cast("timestamp").alias("timestamp"),
        (F.lit(topic) if isinstance(topic, str) else topic).alias("topic"),
    )


def kafka_sink_options(bootstrap: str) -> dict[str, str]:
    """Options of the Kafka sink; the topic comes from the ``topic`` column."""
    return {"kafka.bootstrap.servers": bootstrap, "kafka.enable.idempotence": "true"}


def with_record_id(records: DataFrame, job: str, run: str | None, batch_id: int) -> DataFrame:
    """Add ``record_id``: job, run, batch, content, and which of the batch's equal records it is.

    Equal records are counted, combined before the shuffle, and numbered, so their order does not matter.
    """
    columns = ["key", "value", "timestamp", "topic"]
    counted = records.groupBy(*columns).agg(F.count("*").alias("_copies"))
    numbered = counted.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies")))
    content = F.concat_ws("\u0001", "topic", F.coalesce("key", F.lit("")), F.coalesce("value", F.lit("")), F.col("timestamp").cast("string"))
    batch = f"{job}/{run or ''}/{batch_id}/"
    return numbered.select(*columns, F.concat(F.lit(batch), F.substring(F.sha2(content, 256), 1, 32), F.lit("/"), "_copy").alias(RECORD_ID))


def write_topic_batch(
    records: DataFrame,
    batch_id: int,
    *,
    job: str,
    run: str | None = None,
    bootstrap: str | None = None,
    path: str | None = None,
) -> None:
    """Send one batch of records; each row's ``topic`` column picks its topic.

    In a folder every ``job``, and every ``run`` of it, numbers its own batches, so several
    may write to one folder. A batch sent again gets new file names: table readers see its
    rows once, a stream that had read the old files reads them again. Every record carries
    an id that is the same when its batch is sent again, by which ``read_topic`` with
    ``once_within`` leaves out what it has read.
    """
    records = with_record_id(records, job, run, batch_id)
    if bootstrap:
        header = F.array(F.struct(F.lit(RECORD_ID).alias("key"), F.col(RECORD_ID).cast("binary").alias("value")))
        records.select("key", "value", "topic", header.alias("headers")).write.format("kafka").options(
            **kafka_sink_options(bootstrap)
        ).save()
    else:
        write_once(records, f"{path}/job={job}", batch_id, ["topic"], run)


def write_topic_stream(
    records: DataFrame, *, bootstrap: str | None = None, path: str | None = None
) -> DataStreamWriter:
    """Streaming writer for records; each row's ``topic`` column picks its topic."""
    if bootstrap:
        return (
            records.select("key", "value", "topic")
            .writeStream.format("kafka")
            .options(**kafka_sink_options(bootstrap))
        )
    return records.writeStream.format("parquet").option("path", path).partitionBy("topic")


def console_sample(df: DataFrame, rows: int = 1000) -> DataStreamWriter:
    """Prints up to ``rows`` rows of each batch."""
    return df.writeStream.format("console").option("numRows", rows).option("truncate", "false")
