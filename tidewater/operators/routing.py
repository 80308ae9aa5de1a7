"""Sorting raw records into topics: app logs and database change records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START_TOPIC = "APP_START"
EVENT_TOPIC = "APP_EVENT"
ODS_PREFIX = "ODS_"

# The tables the warehouse takes from the change stream.
FACT_TABLES = ["order_info", "order_detail"]
DIM_TABLES = ["base_province", "user_info", "sku_info", "base_trademark", "base_category3", "spu_info"]
# Control records carry an empty row; a row's JSON is longer than this.
MIN_ROW_JSON = 3


def route_app_log(logs: DataFrame) -> DataFrame:
    """Add ``topic``: start-up logs have a non-empty ``start`` field, all others are events."""
    start = F.get_json_object("value", "$.start")
    return logs.withColumn("topic", F.when(F.length(start) > 0, START_TOPIC).otherwise(EVENT_TOPIC))


def _ods_topic(table):
    return F.concat(F.lit(ODS_PREFIX), F.upper(table))


def _fields(records: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """``table, type, data`` of change records as text, parsed once per record."""
    return records.select(*keep, F.json_tuple("value", "table", "type", "data").alias("table", "type", "data"))


def route_cdc_object(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``topic, value`` of change records that carry one row each.

    Facts pass as inserts only; dimension rows pass whatever the operation was.
    """
    wanted = (F.col("table").isin(FACT_TABLES) & (F.col("type") == "insert")) | F.col("table").isin(DIM_TABLES)
    return _fields(records, keep).where(wanted & (F.length("data") > MIN_ROW_JSON)).select(
        _ods_topic(F.col("table")).alias("topic"), F.col("data").alias("value"), *keep
    )


def route_cdc_array(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``topic, value`` of change records that carry a list of rows; one output row per element."""
    wanted = F.col("table").isin(FACT_TABLES) & (F.col("type") == "INSERT")
    rows = F.explode(F.from_json("data", "array<string>")).alias("value")
    return _fields(records, keep).where(wanted).select(_ods_topic(F.col("table")).alias("topic"), rows, *keep)
