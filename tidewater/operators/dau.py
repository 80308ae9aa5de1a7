"""Daily active devices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater import schemas
from tidewater.functions.clock import text_time, wall_clock


def to_dau_info(logs: DataFrame, zone: str = "UTC") -> DataFrame:
    """Flat start-up logs with day, hour and minute of ``ts`` in ``zone``."""
    clock = text_time(wall_clock(F.col("ts"), zone))
    return logs.select(
        *[F.col(f"common.{c}").alias(c) for c in ("mid", "uid", "ar", "ch", "vc")],
        F.substring(clock, 1, 10).alias("dt"),
        F.substring(clock, 12, 2).alias("hr"),
        F.substring(clock, 15, 2).alias("mi"),
        "ts",
    )


def dedup_daily(dau: DataFrame) -> DataFrame:
    """First start-up per device and day.

    A minimum over (time, row), combined before the shuffle, so a device with
    very many logs never gathers in one task.
    """
    rest = [c for c in schemas.names(schemas.DAU_INFO) if c not in ("mid", "dt", "ts")]
    first = F.min(F.struct("ts", *rest)).alias("_first")
    return dau.groupBy("mid", "dt").agg(first).select("mid", "dt", "_first.*").select(
        *schemas.names(schemas.DAU_INFO)
    )


def dau_total(dau: DataFrame, date: str | None = None) -> DataFrame:
    """Active devices per day, of one day when given."""
    days = dau if date is None else dau.where(F.col("dt") == date)
    return days.groupBy("dt").agg(F.count("*").alias("total"))


def dau_hour(dau: DataFrame, date: str | None = None) -> DataFrame:
    """Active devices per day and hour of first start-up."""
    days = dau if date is None else dau.where(F.col("dt") == date)
    return days.groupBy("dt", "hr").agg(F.count("*").alias("total"))
