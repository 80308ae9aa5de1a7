"""Tables sorted into files by a unique key, and pages of them that read only their own files.

Beside the rows lies a map with a row for each file: its number in the order, how many rows
come before it, how many it holds, and its last key. A page by number, or after a known key,
finds its files there and reads these, whether it is the first page or the last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FILE_ROWS = 1_000_000


def write_sorted(rows: DataFrame, path: str, sort: Sequence[str], file_rows: int = FILE_ROWS) -> None:
    """Store ``rows`` by ``sort``, whose values must be unique, in files of about ``file_rows`` rows."""
    count = rows.count()
    files = max(1, -(-count // file_rows))
    key = F.struct(*sort)
    placed = rows.repartitionByRange(files, *sort).withColumn("file", F.spark_partition_id()).sortWithinPartitions(*sort)
    # Without rows there is no folder of a file to read the schema from.
    writer = placed.write.mode("overwrite")
    (writer.partitionBy("file") if count else writer).parquet(f"{path}/rows")
    stored = rows.sparkSession.read.parquet(f"{path}/rows")
    held = stored.groupBy("file").agg(F.count("*").alias("n"), F.max(key).alias("last"))
    # As many rows as files.
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    held.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).coalesce(1).write.mode("overwrite").parquet(f"{path}/map")


def _files(spark: SparkSession, path: str, which: Column) -> DataFrame:
    return spark.read.parquet(f"{path}/map").where(which).orderBy("file")


def _rows(spark: SparkSession, path: str, files: list[int]) -> DataFrame:
    return spark.read.parquet(f"{path}/rows").where(F.col("file").isin(files)).drop("file")


def page(spark: SparkSession, path: str, sort: Sequence[str], number: int, size: int) -> DataFrame:
    """Page ``number``, counted from 1."""
    start = (number - 1) * size
    held = _files(spark, path, (F.col("before") < start + size) & (F.col("before") + F.col("n") > start)).collect()
    skipped = start - held[0]["before"] if held else 0
    return _rows(spark, path, [r["file"] for r in held]).orderBy(*sort).offset(max(skipped, 0)).limit(size)


def _beyond(columns: Sequence[Column], values: Sequence) -> Column:
    """Whether the columns, in order, come after the values."""
    after, same = F.lit(False), F.lit(True)
    for column, value in zip(columns, values):
        after = after | (same & (column > F.lit(value)))
        same = same & (column == F.lit(value))
    return after


def page_after(spark: SparkSession, path: str, sort: Sequence[str], last: Sequence | None, size: int) -> DataFrame:
    """The ``size`` rows that follow the row with the sort values ``last``; the first ones without it."""
    if last is None:
        return page(spark, path, sort, 1, size)
    beyond = _beyond([F.col(c) for c in sort], last)
    ends = _beyond([F.col(f"last.{c}") for c in sort], last)
    # The file that holds the next row, and as many after it as the page needs.
    first = _files(spark, path, ends).limit(1).collect()
    if not first:
        return _rows(spark, path, []).limit(0)
    until = first[0]["before"] + first[0]["n"] + size
    held = _files(spark, path, (F.col("file") >= first[0]["file"]) & (F.col("before") < until)).collect()
    # The plain bound on the first column reaches the scan.
    rows = _rows(spark, path, [r["file"] for r in held]).where(F.col(sort[0]) >= F.lit(last[0]))
    return rows.where(beyond).orderBy(*sort).limit(size)
