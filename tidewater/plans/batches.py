"""Sample tables played as batches into stored tables, as the jobs store them, and read back.

Each table starts empty in a new folder below the shared one, takes its rows in several
batches, one of them late and one repeated, and is then read as a report reads it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager, nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.skew import HotKeys
from tidewater.plans import stored
from tidewater.session import checkpoint_root
from tidewater.sinks.parts import PartTable
from tidewater.sinks.tables import CODEC, write_once
from tidewater.streaming import jobs
from tidewater.streaming.state import allocate_batch, order_sums_table

RUN = "sample"


def new_folder(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/tables/{uuid.uuid4().hex}"


def play(batches: Sequence[DataFrame], step: Callable[[DataFrame, int], None], repeated: int = 1) -> None:
    """Run the batches in order; one of them a second time, as after a failure behind its last write."""
    for number, batch in enumerate(batches):
        step(batch, number)
        if number == repeated:
            step(batch, number)


def kept(rows: DataFrame) -> DataFrame:
    """Rows written once, to be read by several batches."""
    folder = new_folder(rows.sparkSession)
    rows.write.option("compression", CODEC).parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


@contextmanager
def kept_by(rows: DataFrame, key: str) -> Iterator[DataFrame]:
    """Rows written once in buckets of ``key``, so that windows and sums over the key move none of them.

    Rows that a shuffle on the key gave lie in these buckets already, a bucket in one task. No key may
    hold a large part of the rows.
    """
    spark, name = rows.sparkSession, f"kept_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = rows.write.bucketBy(buckets, key).option("compression", CODEC).option("path", new_folder(spark))
    writer.saveAsTable(name, format="parquet")
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def new_table(rows: DataFrame, key: str) -> PartTable:
    """``rows``, one a key, in buckets of the key."""
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    table = PartTable(new_folder(rows.sparkSession), ddl, (key,))
    table.upsert(rows, RUN, 0, [key])
    return table


def upserted(changes: DataFrame, ddl: str, key: str, order_by: Sequence[str], turn: Column) -> DataFrame:
    """Latest row a key of a dimension whose changes come in three batches, ``turn`` 0 to 2."""
    spark, changes = changes.sparkSession, kept(changes.withColumn("_turn", turn))
    table = PartTable(new_folder(spark), ddl, (key,))
    parts = [changes.where(F.col("_turn") == i).drop("_turn") for i in range(3)]
    play(parts, lambda batch, number: table.upsert(batch, RUN, number, order_by))
    return table.read(spark)


def user_state(orders: DataFrame, prior: DataFrame, new_state: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """User state after orders in two batches by time, on top of a stored prior state.

    Each batch reads the buckets of its users only.
    """
    spark = orders.sparkSession
    table = jobs.user_state_table(new_folder(spark))
    orders = kept(orders.select("id", "user_id", "create_time"))
    middle = orders.agg(F.percentile_approx(F.unix_date(F.col("create_time").cast("date")), 0.5)).first()[0] or 0
    later = F.unix_date(F.col("create_time").cast("date")) > middle

    def step(batch: DataFrame, number: int) -> None:
        if number == 0:
            table.upsert(batch, RUN, number, ["if_consumed"])
        else:
            known = table.read(spark, table.parts_of(batch), (RUN, number))
            table.upsert(new_state(batch, known), RUN, number, ["if_consumed"])

    play([prior, orders.where(~later), orders.where(later)], step)
    return table.read(spark)


def order_rollup(fact: DataFrame) -> PartTable:
    """Rollup of the fact's rows: two halves by day, and every tenth order late."""
    spark = fact.sparkSession
    table = stored.order_rollup(new_folder(spark))
    fact = kept(fact.select("order_id", "dt", "create_time", "tm_id", "tm_name", "final_detail_amount"))
    late, early = F.col("order_id") % 10 == 3, F.col("dt") < "1996-09-17"
    parts = [fact.where(~late & early), fact.where(~late & ~early), fact.where(late)]
    play(parts, lambda batch, number: table.add(stored.order_partials(batch), RUN, number))
    return table


def device_rollup(logs: DataFrame) -> PartTable:
    """Counts of devices of the flat start-up logs, which come in three batches; the last one is late."""
    spark = logs.sparkSession
    index, table = new_folder(spark), stored.device_rollup(new_folder(spark))
    logs = kept(logs)
    # The first row of a device counts, so all rows of a device come in time or late.
    late, early = F.pmod(F.xxhash64("mid"), F.lit(10)) == 3, F.col("dt") < "2024-01-15"

    def step(batch: DataFrame, number: int) -> None:
        fresh = jobs.new_devices(batch, index, RUN, number).persist()
        write_once(fresh, index, number, ["dt"], RUN)
        table.add(stored.device_partials(fresh), RUN, number)
        fresh.unpersist()

    play([logs.where(~late & early), logs.where(~late & ~early), logs.where(late)], step)
    return table


def allocated(wide: DataFrame, turn: Column, hot: HotKeys | None = None) -> DataFrame:
    """Fact rows ``wide``, with ``arrival``, allocated in three batches, ``turn`` 0 to 2; running sums lie in buckets.

    Where ``hot`` tells that no order dominates, the rows lie in buckets of the order between the batches.
    """
    spark, wide = wide.sparkSession, wide.withColumn("_turn", turn)
    fact, sums = new_folder(spark), order_sums_table(new_folder(spark))

    def step(batch: DataFrame, number: int) -> None:
        rows, totals = allocate_batch(batch, sums, RUN, number)
        write_once(rows, fact, number, run=RUN)
        sums.upsert(totals, RUN, number, ["last_at"], sums.parts_of(batch))

    with kept_by(wide, "order_id") if hot is not None and not hot else nullcontext(kept(wide)) as stored_rows:
        play([stored_rows.where(F.col("_turn") == i).drop("_turn") for i in range(3)], step)
    return spark.read.parquet(fact)


PRICE_CHANGES = "id string, price_cents bigint, change_id bigint, change_line int, source_id bigint, changed_at timestamp_ntz"
