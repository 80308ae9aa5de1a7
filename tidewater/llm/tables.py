"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import checkpoint_root


def keep(df: DataFrame) -> DataFrame:
    """``df`` written once and read back, so that a lost executor recomputes nothing before it.

    The table stays for as long as the result may be read; the owner of the shared
    folder clears it with the application.
    """
    path = f"{checkpoint_root(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str = "doc_id"):
    """Fold 0 to 4 of a row: CRC-32 of its id as text."""
    return F.crc32(F.col(column).cast("string")) % 5


def bounded(df: DataFrame, key: str, rows: int) -> DataFrame:
    """``df`` if it has at most ``rows`` rows, else a sample of about so many by the hash of ``key``.

    For labelled rows only: the result may be broadcast. ``df`` is read twice, so keep it first.
    """
    n = df.count()
    if n <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 40)) < int((1 << 40) * 0.98 * rows / n))
