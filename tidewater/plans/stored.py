"""Rollups that jobs keep by month and day, and the reports that read them.

A batch adds its partial sums to the months it touches, which hold at most a row a day, hour
and brand, in this order. A report of some days reads the folders of their months, of these
the row groups of the days, and adds up what is there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.clock import parse_time, two_digits
from tidewater.operators import trademark
from tidewater.operators.dau import dau_hour
from tidewater.sinks.parts import PartTable


def _month():
    return F.substring("dt", 1, 7).alias("month")


def order_rollup(path: str) -> PartTable:
    """Amount and lines by day, hour and brand."""
    ddl = "dt string, hr string, tm_id string, tm_name string, amount decimal(28,2), lines bigint, month string"
    return PartTable(path, ddl, ("dt", "hr", "tm_id", "tm_name", "month"), by="month")


def order_partials(wide: DataFrame) -> DataFrame:
    """Partial sums of a batch of fact rows."""
    hour = two_digits(F.hour(parse_time(F.col("create_time"))))
    rows = wide.groupBy("dt", _month(), hour.alias("hr"), F.col("tm_id").cast("string").alias("tm_id"), "tm_name")
    return rows.agg(F.sum("final_detail_amount").cast("decimal(28,2)").alias("amount"), F.count("*").alias("lines"))


def device_rollup(path: str) -> PartTable:
    """Devices by day and hour of their first start-up."""
    return PartTable(path, "dt string, hr string, total bigint, month string", ("dt", "hr", "month"), by="month")


def device_partials(devices: DataFrame) -> DataFrame:
    """Counts of the devices that a batch has added to the day table."""
    return dau_hour(devices).withColumn("month", _month())


def days(table: PartTable, spark: SparkSession, start: str, end: str | None = None) -> DataFrame:
    """Stored rows of one day or an inclusive range; folders of other months are not read."""
    end = end or start
    months = F.col("month").between(start[:7], end[:7])
    return table.read(spark).where(months & F.col("dt").between(start, end))


def order_total(table: PartTable, spark: SparkSession, date: str) -> DataFrame:
    """Allocated amount of a day, 0 without orders."""
    total = F.coalesce(F.sum("amount"), F.lit(0)).cast("decimal(28,2)")
    return days(table, spark, date).agg(total.alias("amount")).select(F.lit(date).alias("dt"), "amount")


def order_hour(table: PartTable, spark: SparkSession, start: str, end: str | None = None) -> DataFrame:
    """Allocated amount by day and hour."""
    return days(table, spark, start, end).groupBy("dt", "hr").agg(F.sum("amount").alias("amount"))


def trademark_topn(table: PartTable, spark: SparkSession, start: str, end: str, n: int = 5) -> DataFrame:
    """The brands with the largest amount over a range of days."""
    stat = days(table, spark, start, end).withColumnRenamed("dt", "stat_date")
    return trademark.trademark_topn(stat, start, end, n)


def dau_total(table: PartTable, spark: SparkSession, date: str) -> DataFrame:
    """Active devices of a day; no row for a day without any."""
    return days(table, spark, date).groupBy("dt").agg(F.sum("total").alias("total"))
