"""Tables that grow by whole batches.

Every micro-batch owns the folder ``batch_id=<n>`` of its table and replaces it
as a whole, so a repeated batch leaves the same rows. Batches of a stream lie in
the folder ``run=<id>`` of their checkpoint, so a job that starts anew with a fresh
checkpoint, and numbers from 0 again, adds rows and replaces none. Upserts append the
new versions of a row; readers keep the latest version per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.sources.tables import read_table

BATCH = "batch_id"
RUN = "run"
COMPACT = "compact"
# Of Parquet files that are stored: a quarter to a third smaller than Spark's default.
CODEC = "zstd"


def run_of(batch: DataFrame) -> str:
    """The id that the running query's checkpoint keeps; inside ``foreachBatch`` only."""
    run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not run:
        raise ValueError("not inside a batch of a stream")
    return run


def before(stored: DataFrame, batch_id: int, run: str | None = None) -> DataFrame:
    """Rows of earlier batches of the run, and all of other runs."""
    earlier = F.col(BATCH) < batch_id
    if run is not None and RUN in stored.columns:
        earlier = earlier | (F.col(RUN) != run)
    return stored.where(earlier)


def write_once(
    df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = (), run: str | None = None
) -> None:
    """Write one batch, of a run if named, so that writing it again changes nothing."""
    path = path if run is None else f"{path}/{RUN}={run}"
    writer = df.write.mode("overwrite").option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/{BATCH}={batch_id}")


def latest_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """The latest row per key.

    A maximum over (order, rest of the row), so it combines before the shuffle
    and a key with very many versions never gathers in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    ordered = [c.alias(f"_o{i}") for i, c in enumerate(order)]
    newest = F.max(F.struct(*ordered, F.struct(*rest).alias("_rest"))).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(
        *[F.col(c) if c in keys else F.col(f"_newest._rest.{c}").alias(c) for c in df.columns]
    )


def upsert_by_key(
    df: DataFrame,
    path: str,
    batch_id: int,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    run: str | None = None,
) -> None:
    """Store the batch's latest version of each key; read back with :func:`read_latest`."""
    rows = latest_by_key(df, keys, order_by or [c for c in df.columns if c not in keys])
    write_once(rows, path, batch_id, partition_by, run)


def read_latest(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    ddl: str,
    order_by: Sequence[str] = (),
    before_batch: int | None = None,
) -> DataFrame:
    """Current rows of an upserted table, or those as they were before a batch.

    The later batch wins. Batch numbers of several runs do not compare, so with runs
    the later in ``order_by`` wins, and of equal ones the later batch.
    """
    stored = read_table(spark, path, f"{ddl}, {BATCH} bigint")
    if before_batch is not None:
        stored = before(stored, before_batch)
    order = [*order_by, BATCH] if RUN in stored.columns else [BATCH, *order_by]
    return latest_by_key(stored, keys, order).drop(BATCH, RUN)


def compact(
    spark: SparkSession,
    path: str,
    target: str,
    keys: Sequence[str],
    ddl: str,
    order_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
) -> None:
    """Fold an upserted table's batches into one in a new folder; readers and jobs may go on there.

    Of a table with runs the folded rows are the run ``compact``, beside which jobs put
    theirs, otherwise the batch before all others.
    """
    runs = RUN in read_table(spark, path, f"{ddl}, {BATCH} bigint").columns
    rows = read_latest(spark, path, keys, ddl, order_by)
    write_once(rows, target, -1, partition_by, COMPACT if runs else None)


def archive_raw(logs: DataFrame, path: str, batch_id: int) -> None:
    """Raw log lines as text, one folder per day; ``logs`` has ``value`` and ``dt``."""
    logs.select("value", "dt").write.mode("overwrite").partitionBy("dt").text(f"{path}/{BATCH}={batch_id}")
