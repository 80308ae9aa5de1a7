"""Keyword search by an inverted index instead of splitting every name in every search.

The index has a row for each distinct term of a row's text, with the row's key and sort
columns, in buckets of the term and sorted by it. A search reads the buckets of its terms,
and of these the row groups that hold them; a row that matches by several terms counts once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.text import terms
from tidewater.sinks.parts import PartTable

BUCKETS = 64


def index_rows(rows: DataFrame, column: str, key: str, sort: Sequence[str]) -> DataFrame:
    """``term`` with key and sort columns, once a row and term."""
    found = F.explode(F.array_distinct(terms(F.col(column)))).alias("term")
    return rows.select(found, *dict.fromkeys([key, *sort])).where(F.col("term") != "")


def bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def write_index(rows: DataFrame, column: str, key: str, sort: Sequence[str], path: str) -> None:
    """Build the index of all rows anew."""
    found = index_rows(rows, column, key, sort).withColumn("bucket", bucket(F.col("term")))
    # A frequent term fills several files of its bucket rather than one task.
    dealt = found.repartition("bucket", F.pmod(F.xxhash64(key), F.lit(8))).sortWithinPartitions("bucket", "term", *sort)
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(path)


def read_index(spark: SparkSession, path: str, keyword: str) -> DataFrame:
    """Index rows of the terms of ``keyword``; none for a keyword without terms."""
    found = spark.range(1).select(F.explode(terms(F.lit(keyword))).alias("term"))
    wanted = found.select("term", bucket(F.col("term")).alias("bucket")).distinct().collect()
    named = F.col("bucket").isin([r["bucket"] for r in wanted]) & F.col("term").isin([r["term"] for r in wanted])
    return spark.read.parquet(path).where(named)


def search_page(spark: SparkSession, path: str, rows: PartTable, keyword: str, sort: Sequence[str], start: int = 0, size: int = 20) -> DataFrame:
    """One page of the rows with some term of ``keyword``, in ascending order of ``sort``, which must end with the key.

    Only the page's rows, at most ``size``, are looked up, in the buckets of their keys.
    """
    (key,) = rows.keys
    hits = read_index(spark, path, keyword).select(*dict.fromkeys([key, *sort])).distinct()
    page = hits.orderBy(*sort).offset(start).limit(size).select(key)
    keys = [r[0] for r in page.collect()]
    few = spark.createDataFrame([(k,) for k in keys], page.schema)
    found = rows.read(spark, rows.parts_of(few)).where(F.col(key).isin(keys))
    return found.orderBy(*sort)
