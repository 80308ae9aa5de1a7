"""Joins on a key that may hold a large part of all rows.

Keys of more than ``slice_rows`` rows are found first: candidates by a sketch, which
are then counted exactly. The keys that are found, however
many, stay a table that Spark joins as it sees fit. When there are none, which
is the usual case, joins and windows run plainly on the key. Otherwise rows of
a hot key are dealt into slices of bounded size and the other side's row is
repeated once per slice. Which keys count as hot changes only how work is
spread, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_ROWS = 1_000_000

SLICE = "_slice"
SLICES = "_slices"
BOUNDS = "_bounds"


@dataclass(frozen=True)
class HotKeys:
    """Dominant keys of a table and the number of slices, of ``rows`` rows, each is dealt into; no table if there are none."""

    key: str
    table: DataFrame | None = None
    rows: int = SLICE_ROWS

    def __bool__(self) -> bool:
        return self.table is not None


# Keys that the sketch of :func:`hot_keys` may track; beyond that keys are counted exactly at once.
MOST_TRACKED = 50_000


def hot_keys(df: DataFrame, key: str, slice_rows: int = SLICE_ROWS) -> HotKeys:
    """Keys of more than ``slice_rows`` rows. Reads only the key column of ``df``, at once.

    A table of no more rows has none. Otherwise one sketch a task finds the candidates, so that
    no keys are shuffled: its error is at most 3.5 rows of the table per key it tracks, and it
    tracks so many that every key in question stands out. Only the candidates, fewer than
    rows / ``slice_rows``, are counted exactly.
    """
    keys = df.select(key).where(F.col(key).isNotNull())
    rows = keys.count()
    if rows <= slice_rows:
        return HotKeys(key)
    tracked = 7 * rows // slice_rows + 8
    if tracked <= MOST_TRACKED:
        most = F.call_function("approx_top_k", F.col(key), F.lit(min(tracked, rows // slice_rows + 1)), F.lit(tracked))
        found = keys.agg(F.transform(most, lambda x: x["item"]).alias(key)).select(F.explode(key).alias(key))
        keys = keys.join(F.broadcast(found), key, "left_semi")
    counts = keys.groupBy(key).agg(F.count("*").alias("_rows")).where(F.col("_rows") > slice_rows)
    table = counts.select(key, F.ceil(F.col("_rows") / slice_rows).cast("int").alias(SLICES)).persist()
    return HotKeys(key, None if table.isEmpty() else table, slice_rows)


def deal(df: DataFrame, hot: HotKeys, by: Sequence[str]) -> DataFrame:
    """Add ``_slices`` and ``_slice``; rows of a hot key are dealt by a hash of ``by``."""
    dealt = F.pmod(F.xxhash64(*by), F.col(SLICES))
    return (
        df.join(hot.table, hot.key, "left")
        .withColumn(SLICES, F.coalesce(SLICES, F.lit(1)))
        .withColumn(SLICE, F.when(F.col(SLICES) > 1, dealt).otherwise(0).cast("int"))
    )


# Rows of a slice that the bounds of ranges are taken from.
SAMPLED = 64


def ranges(df: DataFrame, hot: HotKeys, by: str) -> HotKeys:
    """``hot`` with the values ``_bounds`` of ``by`` that cut each key's rows into ranges of about a slice, in ascending order.

    The bounds are quantiles of a sample, which a hash of ``by`` picks, so they are the same each time.
    """
    picked = F.pmod(F.xxhash64(by), F.lit(max(1, hot.rows // SAMPLED))) == 0
    sample = df.select(hot.key, by).where(picked).groupBy(hot.key).agg(F.sort_array(F.collect_set(by)).alias("_sample"))
    upto = lambda i: F.floor(i * F.size("_sample") / F.col(SLICES)).cast("int")
    cuts = F.transform(F.sequence(F.lit(1), F.col(SLICES) - 1), lambda i: F.get(F.col("_sample"), upto(i) - 1))
    bounds = F.array_distinct(F.array_compact(cuts)).alias(BOUNDS)
    cut = hot.table.join(sample, hot.key).select(hot.key, bounds)
    # Both sides of a join, in each of its uses, take the same few columns of the hot keys.
    return HotKeys(hot.key, cut.withColumn(SLICES, F.size(BOUNDS) + 1).persist(), hot.rows)


def deal_ranges(df: DataFrame, cut: HotKeys, by: str) -> DataFrame:
    """Add ``_slices`` and ``_slice``; rows of a key with :func:`ranges` are dealt in the order of ``by``, nulls first."""
    below = F.size(F.filter(BOUNDS, lambda b: b < F.col(by)))
    return (
        df.join(cut.table, cut.key, "left")
        .withColumn(SLICES, F.coalesce(SLICES, F.lit(1)))
        .withColumn(SLICE, F.when(F.col(SLICES) > 1, below).otherwise(0))
        .drop(BOUNDS)
    )


def repeat(df: DataFrame, hot: HotKeys) -> DataFrame:
    """Repeat a row of a hot key once per slice, numbered in ``_slice``."""
    last = F.coalesce(F.col(SLICES), F.lit(1)) - 1
    return (
        df.join(hot.table.select(hot.key, SLICES), hot.key, "left")
        .withColumn(SLICE, F.explode(F.sequence(F.lit(0), last)))
        .withColumn(SLICES, last + 1)
    )


# Keys up to which :func:`only_keys` sends them to every task: 8 bytes each.
FEW_KEYS = 1_000_000


def only_keys(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows whose ``key`` is in the one column of ``wanted``, sorted out before any exchange where keys are few.

    Counts ``wanted`` at once. Up to :data:`FEW_KEYS` keys go to every task; beyond that Spark
    joins as it sees fit.
    """
    (column,) = wanted.columns
    keys = wanted.select(F.col(column).alias(key)).distinct()
    return rows.join(F.broadcast(keys) if keys.count() <= FEW_KEYS else keys, key, "left_semi")
