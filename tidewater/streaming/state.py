"""Stream forms of the stateful steps: order/line join, running allocation, late rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.skew import SLICE_ROWS, HotKeys, hot_keys
from tidewater.operators.wide import DETAIL_COLUMNS, ORDER_COLUMNS, STATE_TTL_SECONDS, allocate_amount, order_sums, to_order_wide
from tidewater.sinks.parts import PartTable

# Shares that the lines of an order are dealt into; the order is kept once for each.
SALTS = 8


def join_orders_stream(
    orders: DataFrame, details: DataFrame, within: str, delay: str | None = None, salts: int = SALTS
) -> DataFrame:
    """Order fact rows whose order and line arrive less than ``within`` apart, each line once.

    Both sides carry their arrival in ``timestamp``. Rows more than ``delay``
    (default ``within``) behind the newest arrival of their side may be dropped;
    :func:`split_late` tells them apart before. Lines of an order are dealt over
    ``salts`` tasks by a hash of their id, and so is the state that waits for them.
    """
    delay = delay or within
    heads = orders.select(
        *[F.col(a).alias(b) for a, b in ORDER_COLUMNS.items()],
        F.col("timestamp").alias("_order_at"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_order_salt"),
    ).withWatermark("_order_at", delay)
    lines = details.select(
        F.col("order_id").alias("_line_order"),
        *[F.col(a).alias(b) for a, b in DETAIL_COLUMNS.items()],
        F.col("timestamp").alias("arrival"),
        F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("_salt"),
    ).withWatermark("arrival", delay)
    reach = F.expr(f"interval {within}")
    near = (F.col("arrival") > F.col("_order_at") - reach) & (F.col("arrival") < F.col("_order_at") + reach)
    same = (F.col("order_id") == F.col("_line_order")) & (F.col("_order_salt") == F.col("_salt"))
    joined = heads.join(lines, same & near)
    # One event-time column may remain for the dedup.
    pairs = joined.drop("_order_at", "_line_order", "_order_salt").dropDuplicatesWithinWatermark(["order_id", "order_detail_id", "_salt"])
    return to_order_wide(pairs, ("arrival",))


def order_sums_table(path: str) -> PartTable:
    """Sums of each order's lines so far and the arrival of the last."""
    return PartTable(path, "order_id bigint, amounts bigint, shares bigint, lines bigint, last_at timestamp", ("order_id",))


def allocate_batch(
    batch: DataFrame, sums: PartTable, run: str, batch_id: int, ttl_seconds: int = STATE_TTL_SECONDS
) -> tuple[DataFrame, DataFrame]:
    """A micro-batch of fact rows with amounts allocated, and the sums to store after it.

    Lines count in the order of their batches and within one of their ids. What earlier
    batches summed comes from the buckets of the batch's orders only. Sums that nothing was
    added to for ``ttl_seconds`` before the batch are forgotten.
    """
    spark = batch.sparkSession
    rows, first = batch.agg(F.count("*"), F.min("arrival")).first()
    hot = HotKeys("order_id") if rows <= SLICE_ROWS else hot_keys(batch, "order_id")
    since = (first or dt.datetime.fromtimestamp(0)) - dt.timedelta(seconds=ttl_seconds)
    known = sums.read(spark, sums.parts_of(batch), (run, batch_id)).where(F.col("last_at") >= F.lit(since))
    allocated = allocate_amount(batch, hot, carried=known)
    # Both sides have one row an order, so they meet by a join that leaves the batch's sums where they are.
    added = order_sums(batch, F.max("arrival").alias("last_at")).alias("a").join(known.alias("k"), "order_id", "left")
    plus = lambda c: F.coalesce(F.col(f"a.{c}") + F.col(f"k.{c}"), f"a.{c}", f"k.{c}").alias(c)
    totals = added.select(
        "order_id", *[plus(c) for c in ("amounts", "shares", "lines")], F.greatest("a.last_at", "k.last_at").alias("last_at")
    )
    return allocated, totals


def newest_table(path: str) -> PartTable:
    """The newest time that earlier batches held."""
    return PartTable(path, "side string, newest timestamp", ("side",), buckets=1)


def split_late(batch: DataFrame, newest: PartTable, run: str, batch_id: int, delay_seconds: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows in time, rows that a watermark of ``delay_seconds`` would drop, and the newest time to store.

    A row is late when its ``timestamp`` lies ``delay_seconds`` or more before the newest of
    earlier batches. A following job whose batches hold whole batches of this one knows no
    newer time, so it drops none of the rows in time.
    """
    spark = batch.sparkSession
    known = newest.read(spark, before=(run, batch_id)).agg(F.max("newest")).first()[0]
    if known is None:
        late = F.lit(False)
    else:
        late = F.col("timestamp") <= F.lit(known - dt.timedelta(seconds=delay_seconds))
    after = batch.agg(F.lit("all").alias("side"), F.greatest(F.max("timestamp"), F.lit(known).cast("timestamp")).alias("newest"))
    return batch.where(~late), batch.where(late), after
