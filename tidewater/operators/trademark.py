"""Brand sales: partial sums per batch, totals over days, top n."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.clock import text_time, wall_clock
from tidewater.functions.money import round_half_up


def trademark_batch_stat(wide: DataFrame, stat_time: Column) -> DataFrame:
    """Allocated amount per brand and batch; ``stat_time`` is the batch's clock as text.

    Groups on id and name as two columns, so names may hold any character.
    """
    return (
        wide.groupBy(stat_time.alias("stat_time"), F.col("tm_id").cast("string").alias("tm_id"), "tm_name")
        .agg(F.sum("final_detail_amount").alias("_sum"))
        .select(
            F.substring("stat_time", 1, 10).alias("stat_date"),
            "stat_time",
            "tm_id",
            "tm_name",
            round_half_up(F.col("_sum")).cast("decimal(18,2)").alias("amount"),
        )
    )


def trademark_totals(stat: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Amount per brand over an inclusive range of days, all days when open."""
    if start is not None:
        stat = stat.where(F.col("stat_date") >= start)
    if end is not None:
        stat = stat.where(F.col("stat_date") <= end)
    return stat.groupBy("tm_id", "tm_name").agg(F.sum("amount").alias("amount"))


def trademark_topn(stat: DataFrame, start: str | None = None, end: str | None = None, n: int = 5) -> DataFrame:
    """The ``n`` brands with the largest amount; equal amounts by id."""
    return trademark_totals(stat, start, end).orderBy(F.desc("amount"), "tm_id").limit(n)


def to_datav(top: DataFrame) -> DataFrame:
    """Chart rows: brand name, amount, constant series."""
    return top.select(F.col("tm_name").alias("x"), F.col("amount").alias("y"), F.lit("1").alias("s"))


# Sums of sums of money.
SLIDING_AMOUNT = "decimal(28,2)"


def sliding_amount(wide: DataFrame, at: Column, window_seconds: int, slide_seconds: int) -> DataFrame:
    """Allocated amount per brand and sliding window; ``at`` is a line's time in whole seconds.

    Lines are summed in panes of one slide, so that only panes, not lines, are repeated
    for the windows they lie in. Windows start at multiples of the slide.
    """
    pane = (F.floor(at / slide_seconds) * slide_seconds).cast("bigint")
    panes = wide.groupBy(pane.alias("_pane"), F.col("tm_id").cast("string").alias("tm_id"), "tm_name").agg(
        F.sum("final_detail_amount").alias("_sum")
    )
    starts = F.sequence(F.col("_pane") - (window_seconds - slide_seconds), F.col("_pane"), F.lit(slide_seconds).cast("bigint"))
    sums = panes.select(F.explode(starts).alias("_start"), "tm_id", "tm_name", "_sum").groupBy("_start", "tm_id", "tm_name")
    clock = lambda seconds: text_time(wall_clock(seconds * 1000))
    return sums.agg(F.sum("_sum").alias("amount")).select(
        clock(F.col("_start")).alias("window_start"),
        clock(F.col("_start") + window_seconds).alias("window_end"),
        "tm_id",
        "tm_name",
        F.col("amount").cast(SLIDING_AMOUNT).alias("amount"),
    )
