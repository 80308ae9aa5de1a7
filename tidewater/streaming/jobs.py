"""Running queries, one per hop of the warehouse.

Every job takes streams of ``key, value, timestamp`` records and returns a
started query. Progress lives in the checkpoint; jobs that write several
outputs or keep a state table do so per batch, addressed by the checkpoint's id and
batch number, so a repeated batch leaves the same rows and a fresh checkpoint adds its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidewater import schemas
from tidewater.operators import dims, orders, routing, trademark
from tidewater.operators.dau import dedup_daily, to_dau_info
from tidewater.operators.wide import SLIDE_SECONDS, STATE_TTL_SECONDS, WINDOW_SECONDS
from tidewater.plans import stored
from tidewater.sinks.parts import PartTable
from tidewater.sinks.tables import before, run_of, write_once
from tidewater.sinks.topics import to_records, write_topic_batch, write_topic_stream
from tidewater.sources.decode import decode, undecodable
from tidewater.sources.tables import read_table
from tidewater.streaming.state import allocate_batch, join_orders_stream, newest_table, order_sums_table, split_late

INTERVAL = "5 seconds"

# Topics that other systems read.
ORDER_TOPIC = "DWD_ORDER_INFO"
DETAIL_TOPIC = "DWD_ORDER_DETAIL"
WIDE_TOPIC = "DWS_ORDER_WIDE"

Sink = dict[str, str]  # bootstrap=... or path=...


def run(writer: DataStreamWriter, name: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Start a query every :data:`INTERVAL`, or once over what is there."""
    trigger = {"availableNow": True} if available_now else {"processingTime": INTERVAL}
    return (
        writer.queryName(name).option("checkpointLocation", f"{checkpoint}/{name}").trigger(**trigger).start()
    )


# --- ingest -----------------------------------------------------------------


def keep_undecodable(records: DataFrame, ddl: str, path: str) -> DataStreamWriter:
    """Records that the job reading this topic as ``ddl`` leaves out, with their time, as a table.

    Runs beside that job, with its own checkpoint.
    """
    bad = undecodable(records, ddl, keep=("timestamp",))
    return bad.writeStream.format("parquet").option("path", path)


def route_logs(logs: DataFrame, sink: Sink) -> DataStreamWriter:
    """App logs to the start-up and event topics."""
    return write_topic_stream(routing.route_app_log(logs), **sink)


def archive_logs(logs: DataFrame, path: str) -> DataStreamWriter:
    """Raw log lines as text files, a folder per day received."""
    lines = logs.select("value", F.to_date("timestamp").cast("string").alias("dt"))
    return lines.writeStream.format("text").option("path", path).partitionBy("dt")


def route_changes(records: DataFrame, sink: Sink, arrays: bool = False) -> DataStreamWriter:
    """Change records to one topic per table."""
    route = routing.route_cdc_array if arrays else routing.route_cdc_object
    routed = route(records, keep=("timestamp",)).withColumn("key", F.lit(None).cast("string"))
    return write_topic_stream(routed.select("key", "value", "timestamp", "topic"), **sink)


# --- dimensions -------------------------------------------------------------

CHANGED = "changed_at"


def dim_table(path: str, ddl: str, key: str) -> PartTable:
    """The stored form of a dimension: buckets of its key."""
    return PartTable(path, f"{ddl}, {CHANGED} timestamp", (key,))


def read_dim(
    spark: SparkSession, path: str, ddl: str, key: str, facts: DataFrame | None = None, fact_key: str | None = None
) -> DataFrame:
    """A dimension as of now; read inside each batch, so changes show at once.

    Given the facts that look up in it, only the buckets of their keys.
    """
    table = dim_table(path, ddl, key)
    parts = None if facts is None else table.parts_of(facts.select(F.col(fact_key).cast("string").alias(key)))
    return table.read(spark, parts).drop(CHANGED)


def user_state_table(path: str) -> PartTable:
    """Users that have bought, in buckets."""
    return PartTable(path, schemas.USER_STATE, ("user_id",))


def maintain_dim(
    rows: DataFrame, path: str, ddl: str, key: str, derive: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataStreamWriter:
    """Upsert a dimension from its change topic; ``derive`` adds columns per batch."""
    decoded = decode(rows, ddl, keep=("timestamp",)).withColumnRenamed("timestamp", CHANGED)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            derived = derive(batch)
            columns = [f for f in derived.schema.fields if f.name != CHANGED]
            ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in columns)
            dim_table(path, ddl, key).upsert(derived, run_of(batch), batch_id, [CHANGED])

    return decoded.writeStream.foreachBatch(upsert)


def maintain_trademark(rows: DataFrame, path: str) -> DataStreamWriter:
    derive = lambda df: df.select(F.coalesce("tm_id", "id").alias("tm_id"), "tm_name", CHANGED)
    return maintain_dim(rows, path, schemas.BASE_TRADEMARK, "tm_id", derive)


def maintain_user(rows: DataFrame, path: str, as_of: Column | None = None) -> DataStreamWriter:
    day = F.current_date() if as_of is None else as_of
    return maintain_dim(rows, path, schemas.USER_INFO, "id", lambda df: dims.derive_user(df, day))


def maintain_sku(rows: DataFrame, path: str, category3: str, trademark_path: str, spu: str) -> DataStreamWriter:
    """SKUs with the names their category, brand and product have at that moment."""

    def derive(batch: DataFrame) -> DataFrame:
        spark = batch.sparkSession
        return dims.build_sku_dim(
            batch,
            read_dim(spark, category3, schemas.BASE_CATEGORY3, "id", batch, "category3_id"),
            read_dim(spark, trademark_path, "tm_id string, tm_name string", "tm_id", batch, "tm_id"),
            read_dim(spark, spu, schemas.SPU_INFO, "id", batch, "spu_id"),
        )

    return maintain_dim(rows, path, schemas.SKU_INFO, "id", derive)


# --- facts ------------------------------------------------------------------


def enrich_orders(rows: DataFrame, sink: Sink, state: str, provinces: str, users: str) -> DataStreamWriter:
    """Orders with first-order flag and dimension attributes; new buyers go to the state table.

    The flag looks only at state of earlier batches, so repeating a batch gives the same flags.
    """
    decoded = decode(rows, schemas.ORDER_INFO, keep=("timestamp",))

    def enrich(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            run = run_of(batch)
            bought = user_state_table(state)
            known = bought.read(spark, bought.parts_of(batch), (run, batch_id))
            wide = orders.order_info_wide(
                batch,
                known,
                read_dim(spark, provinces, schemas.BASE_PROVINCE, "id", batch, "province_id"),
                read_dim(spark, users, schemas.USER_DIM, "id", batch, "user_id"),
                keep=("timestamp",),
            )
            records = to_records(wide, ORDER_TOPIC, "id", F.col("timestamp"))
            write_topic_batch(records, batch_id, job=ORDER_TOPIC, run=run, **sink)
            bought.upsert(orders.new_user_state(batch, known), run, batch_id, ["if_consumed"])
        finally:
            batch.unpersist()

    return decoded.writeStream.foreachBatch(enrich)


def enrich_details(rows: DataFrame, sink: Sink, skus: str) -> DataStreamWriter:
    """Order lines with the attributes of their SKU."""
    decoded = decode(rows, schemas.ORDER_DETAIL, keep=("timestamp",))

    def enrich(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            wide = orders.join_sku(batch, read_dim(batch.sparkSession, skus, schemas.SKU_DIM, "id", batch, "sku_id"))
            records = to_records(wide, DETAIL_TOPIC, timestamp=F.col("timestamp"))
            write_topic_batch(records, batch_id, job=DETAIL_TOPIC, run=run_of(batch), **sink)

    return decoded.writeStream.foreachBatch(enrich)


def build_order_wide(
    order_records: DataFrame,
    detail_records: DataFrame,
    fact: str,
    sink: Sink,
    within: str = f"{WINDOW_SECONDS} seconds",
    delay: str | None = None,
    sums: str | None = None,
) -> DataStreamWriter:
    """Join, dedup, allocate; rows go to the fact table by day and to the next topic.

    ``within`` is 15 seconds for the windowed join; :data:`CACHE_WITHIN` gives the long-lived one.
    ``delay`` is the watermark's, as long as ``within`` if open; :func:`keep_late` in front, with the
    same delay, puts the rows aside that it would drop. The running sums of orders are stored in
    ``sums``, beside the fact if open.
    """
    pairs = join_orders_stream(
        decode(order_records, schemas.ORDER_INFO_WIDE, keep=("timestamp",)),
        decode(detail_records, schemas.ORDER_DETAIL_WIDE, keep=("timestamp",)),
        within,
        delay,
    )
    so_far = order_sums_table(sums or f"{fact.rstrip('/')}_sums")

    def store(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            run = run_of(batch)
            allocated, totals = allocate_batch(batch, so_far, run, batch_id)
            write_once(allocated.select(*schemas.names(schemas.ORDER_WIDE)), fact, batch_id, ["dt"], run)
            records = to_records(allocated, WIDE_TOPIC, timestamp=F.col("arrival"))
            write_topic_batch(records, batch_id, job=WIDE_TOPIC, run=run, **sink)
            so_far.upsert(totals, run, batch_id, ["last_at"])
        finally:
            batch.unpersist()

    return pairs.writeStream.outputMode("append").foreachBatch(store)


def keep_late(records: DataFrame, topic: str, sink: Sink, late: str, delay: str) -> DataStreamWriter:
    """Pass records on to ``topic``; those that a watermark of ``delay`` would drop go to the table ``late``.

    ``delay`` is a number of seconds, minutes or hours, as ``15 seconds``.
    """
    number, unit = delay.split()
    seconds = int(number) * {"second": 1, "minute": 60, "hour": 3600}[unit.rstrip("s")]
    newest = newest_table(f"{late.rstrip('/')}_newest")

    def split(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            run = run_of(batch)
            passed, behind, after = split_late(batch, newest, run, batch_id, seconds)
            out = passed.withColumn("topic", F.lit(topic))
            write_topic_batch(out, batch_id, job=topic, run=run, **sink)
            write_once(behind, late, batch_id, run=run)
            newest.upsert(after, run, batch_id, ["newest"])
        finally:
            batch.unpersist()

    return records.select("key", "value", "timestamp").writeStream.foreachBatch(split)


CACHE_WITHIN = f"{STATE_TTL_SECONDS} seconds"


# --- results ----------------------------------------------------------------


def sum_trademarks(wide_records: DataFrame, path: str, bucket: str = INTERVAL) -> DataStreamWriter:
    """Brand sums per batch; each batch owns its rows, so they count exactly once."""
    decoded = decode(wide_records, schemas.ORDER_WIDE, keep=("timestamp",))
    clock = F.date_format(F.window("timestamp", bucket)["start"], "yyyy-MM-dd HH:mm:ss")

    def store(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            stat = trademark.trademark_batch_stat(batch.withColumn("_clock", clock), F.col("_clock"))
            write_once(stat, path, batch_id, ["stat_date"], run_of(batch))

    return decoded.writeStream.foreachBatch(store)


def slide_trademarks(
    wide_records: DataFrame, path: str, delay: str, window: str = f"{WINDOW_SECONDS} seconds", slide: str = f"{SLIDE_SECONDS} seconds"
) -> DataStreamWriter:
    """Brand sums of sliding windows, by day of their start; a window is written once the watermark has passed it.

    Rows are summed in panes of one slide first, and panes in windows. Records more than
    ``delay`` behind the newest may be left out.
    """
    brand = [F.col("tm_id").cast("string").alias("tm_id"), "tm_name"]
    rows = decode(wide_records, schemas.ORDER_WIDE, keep=("timestamp",)).withWatermark("timestamp", delay)
    panes = rows.groupBy(F.window("timestamp", slide).alias("pane"), *brand).agg(F.sum("final_detail_amount").alias("amount"))
    sums = panes.groupBy(F.window("pane", window, slide).alias("_w"), "tm_id", "tm_name").agg(F.sum("amount").alias("amount"))
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    found = sums.select(
        text(F.col("_w.start")).alias("window_start"), text(F.col("_w.end")).alias("window_end"), "tm_id", "tm_name",
        F.col("amount").cast(trademark.SLIDING_AMOUNT).alias("amount"),
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            write_once(batch.withColumn("dt", F.substring("window_start", 1, 10)), path, batch_id, ["dt"], run_of(batch))

    return found.writeStream.outputMode("append").foreachBatch(store)


def roll_up_orders(wide_records: DataFrame, path: str) -> DataStreamWriter:
    """Amounts and lines by day, hour and brand, added up over batches; late rows go to their own day."""
    decoded = decode(wide_records, schemas.ORDER_WIDE)

    def store(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            stored.order_rollup(path).add(stored.order_partials(batch), run_of(batch), batch_id)

    return decoded.writeStream.foreachBatch(store)


def index_active_devices(start_logs: DataFrame, path: str, zone: str = "UTC", rollup: str | None = None) -> DataStreamWriter:
    """First start-up per device and day into a table by day; counts by day and hour into ``rollup`` if named.

    Days never close, so a late row is not lost.
    """
    devices = to_dau_info(decode(start_logs, schemas.START_LOG), zone)

    def store(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        batch = batch.persist()
        try:
            run = run_of(batch)
            fresh = new_devices(batch, path, run, batch_id)
            write_once(fresh, path, batch_id, ["dt"], run)
            if rollup:
                stored.device_rollup(rollup).add(stored.device_partials(fresh), run, batch_id)
        finally:
            batch.unpersist()

    return devices.writeStream.foreachBatch(store)


def new_devices(batch: DataFrame, path: str, run: str, batch_id: int) -> DataFrame:
    """The earliest row of every device of the batch that no earlier batch has stored for that day.

    Only the batch's own days are read.
    """
    days = [r["dt"] for r in batch.select("dt").distinct().collect()]
    known = read_table(batch.sparkSession, path, f"{schemas.DAU_INFO}, batch_id bigint")
    known = before(known, batch_id, run).where(F.col("dt").cast("string").isin(days))
    known = known.select("mid", F.col("dt").cast("string").alias("dt"))
    return dedup_daily(batch).join(known, ["mid", "dt"], "left_anti")
