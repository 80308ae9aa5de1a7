"""Stored tables and JDBC queries."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def empty_table(spark: SparkSession, ddl: str) -> DataFrame:
    """No rows, known as such to the optimizer, which then drops the joins with it."""
    return spark.createDataFrame([], ddl).limit(0)


def read_table(spark: SparkSession, path: str, ddl: str | None = None) -> DataFrame:
    """A Parquet table; an absent one reads as empty when its schema is given."""
    try:
        return spark.read.option("basePath", path).parquet(path)
    except AnalysisException as missing:
        if ddl is None or missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return empty_table(spark, ddl)


def read_days(
    spark: SparkSession, path: str, start: str, end: str | None = None, day_column: str = "dt"
) -> DataFrame:
    """Rows of one day or an inclusive range; prunes partitions when stored by day."""
    days = F.col(day_column).cast("string")
    table = read_table(spark, path)
    return table.where(days == start) if end is None else table.where(days.between(start, end))


def jdbc_query_options(url: str, sql: str, **extra: str) -> dict[str, str]:
    return {"url": url, "query": sql, **extra}


def read_query(spark: SparkSession, url: str, sql: str, **extra: str) -> DataFrame:
    """Result of a SQL text run by a JDBC database; columns as the database names them.

    Give ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``
    with a ``dbtable`` read for large tables; a ``query`` read uses one connection.
    """
    return spark.read.format("jdbc").options(**jdbc_query_options(url, sql, **extra)).load()
