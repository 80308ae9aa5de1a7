"""Append rows to a JDBC table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def jdbc_write_options(
    url: str, table: str, batch_size: int = 100, partitions: int | None = None, isolation: str = "NONE", **extra: str
) -> dict[str, str]:
    """Options of the writer; ``partitions`` narrows the whole job to so many tasks, so it is unset by default."""
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_size),
        "isolationLevel": isolation,
        **({"numPartitions": str(partitions)} if partitions else {}),
        **extra,
    }


def write_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    df.write.format("jdbc").mode("append").options(**jdbc_write_options(url, table, **options)).save()
