"""Streams give what the batch transforms give: in batches, after restarts, with repeats."""

import datetime as dt
import glob
import time

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows
from tidewater import schemas
from tidewater.operators import dau as dau_ops
from tidewater.operators import orders, routing, trademark, wide
from tidewater.operators.skew import HotKeys
from tidewater.plans import queries
from tidewater.session import checkpoint_root
from tidewater.sinks.topics import to_records
from tidewater.sources import sample
from tidewater.sources.decode import decode
from tidewater.sources.tables import read_table
from tidewater.sources.topics import read_topic
from tidewater.streaming import jobs

LIMIT = 180  # seconds before a stream counts as stuck
NONE_HOT = HotKeys("order_id")


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def finish(writer, name, checkpoint):
    """Run a job over everything there is, and return after it has stopped."""
    query = jobs.run(writer, name, checkpoint, available_now=True)
    try:
        assert query.awaitTermination(LIMIT), f"{name} did not stop"
    finally:
        query.stop()


def send(records, root):
    """Append one file of records to a folder of topics."""
    records.coalesce(1).write.mode("append").partitionBy("topic").parquet(root)
    time.sleep(0.02)  # file sources read in order of modification time


def topic(spark, name, root, **options):
    return read_topic(spark, name, path=root, max_files_per_trigger=1, **options)


def at(seconds):
    return dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=seconds)


def test_checkpoint_root(spark):
    assert checkpoint_root(spark).startswith("/")


def test_logs_to_daily_devices(spark, folder):
    raw, routed, index, archive, ck = (f"{folder}/{n}" for n in ("raw", "routed", "index", "archive", "ck"))
    logs = sample.app_logs(spark, SMALL)
    arrival = F.timestamp_millis(F.get_json_object("value", "$.ts").cast("bigint"))
    records = logs.select(F.lit(None).cast("string").alias("key"), "value", arrival.alias("timestamp"), F.lit("RAW").alias("topic"))

    def play():
        source = lambda: topic(spark, "RAW", raw)
        finish(jobs.route_logs(source(), {"path": routed}), "route", ck)
        finish(jobs.archive_logs(source(), archive), "archive", ck)
        starts = read_topic(spark, routing.START_TOPIC, path=routed)
        finish(jobs.index_active_devices(starts, index), "devices", ck)

    early, late = records.where("timestamp < '2024-01-16'"), records.where("timestamp >= '2024-01-16'")
    send(early, raw)
    send(early.where("timestamp >= '2024-01-15'"), raw)  # sent twice
    play()
    send(late, raw)
    play()  # restarts from the checkpoint

    expected = queries.queries()["dau_detail"](spark, SMALL)
    got = read_table(spark, index)
    columns = schemas.names(schemas.DAU_INFO)
    assert rows(got.withColumn("dt", F.col("dt").cast("string")), *columns) == rows(expected, *columns)
    batch_topics = routing.route_app_log(logs).groupBy("topic").count()
    sent_twice = routing.route_app_log(early.where("timestamp >= '2024-01-15'").drop("topic")).groupBy("topic").count()
    both = batch_topics.unionByName(sent_twice).groupBy("topic").agg(F.sum("count"))
    assert rows(spark.read.parquet(routed).groupBy("topic").count()) == rows(both)
    assert spark.read.text(archive).count() == logs.count() + early.where("timestamp >= '2024-01-15'").count()
    assert len(glob.glob(f"{archive}/dt=*")) == logs.select("dt").distinct().count()


@pytest.mark.parametrize("arrays", [False, True])
def test_change_records_to_topics(spark, folder, arrays):
    changes = (sample.cdc_arrays if arrays else sample.cdc_objects)(spark, SMALL)
    records = changes.select(
        F.lit(None).cast("string").alias("key"), "value", F.current_timestamp().alias("timestamp"), F.lit("DB").alias("topic")
    )
    send(records, f"{folder}/db")
    finish(jobs.route_changes(topic(spark, "DB", f"{folder}/db"), {"path": f"{folder}/ods"}, arrays), "cdc", f"{folder}/ck")
    route = routing.route_cdc_array if arrays else routing.route_cdc_object
    got = spark.read.parquet(f"{folder}/ods")
    assert rows(got.groupBy("topic").count()) == rows(route(changes).groupBy("topic").count())
    assert got.select("value").exceptAll(route(changes).select("value")).isEmpty()


def test_dimensions_follow_changes(spark, folder):
    ods, ck = f"{folder}/ods", f"{folder}/ck"

    def change(name, data, ddl, second):
        df = spark.createDataFrame(data, ddl)
        send(to_records(df, name, timestamp=F.lit(at(second))), ods)

    def play():
        source = lambda name: topic(spark, name, ods)
        finish(jobs.maintain_dim(source("ODS_BASE_CATEGORY3"), f"{folder}/c3", schemas.BASE_CATEGORY3, "id"), "c3", ck)
        finish(jobs.maintain_trademark(source("ODS_BASE_TRADEMARK"), f"{folder}/tm"), "tm", ck)
        finish(jobs.maintain_dim(source("ODS_SPU_INFO"), f"{folder}/spu", schemas.SPU_INFO, "id"), "spu", ck)
        finish(jobs.maintain_user(source("ODS_USER_INFO"), f"{folder}/user", F.lit("2024-01-01")), "user", ck)
        finish(
            jobs.maintain_sku(source("ODS_SKU_INFO"), f"{folder}/sku", f"{folder}/c3", f"{folder}/tm", f"{folder}/spu"),
            "sku",
            ck,
        )

    change("ODS_BASE_CATEGORY3", [("61", "phones", "1")], schemas.BASE_CATEGORY3, 1)
    change("ODS_BASE_TRADEMARK", [(None, "1", "old name")], schemas.BASE_TRADEMARK, 1)
    change("ODS_BASE_TRADEMARK", [("1", None, "new name"), ("2", None, "other")], schemas.BASE_TRADEMARK, 2)
    change("ODS_SPU_INFO", [("9", "product")], schemas.SPU_INFO, 1)
    change("ODS_USER_INFO", [("5", "1", "1990-01-01", "M"), ("6", "1", "2010-01-01", None)], schemas.USER_INFO, 1)
    change("ODS_SKU_INFO", [("7", "9", "1.00", "sku", "1", "61", "t"), ("8", "9", "1.00", "sku8", "3", "61", "t")], schemas.SKU_INFO, 1)
    play()
    change("ODS_USER_INFO", [("5", "2", "1990-01-01", "M")], schemas.USER_INFO, 2)
    change("ODS_SKU_INFO", [("7", "9", "2.00", "sku", "2", "61", "t")], schemas.SKU_INFO, 2)
    play()

    read = lambda name, ddl, key: jobs.read_dim(spark, f"{folder}/{name}", ddl, key)
    assert rows(read("tm", "tm_id string, tm_name string", "tm_id")) == [("1", "new name"), ("2", "other")]
    assert rows(read("user", schemas.USER_DIM, "id"), "id", "user_level", "age_group", "gender_name") == [
        ("5", "2", "30岁以上", "男"), ("6", "1", "20岁及以下", "女"),
    ]
    assert rows(read("sku", schemas.SKU_DIM, "id"), "id", "price", "category3_name", "spu_name", "tm_name") == [
        ("7", "2.00", "phones", "product", "other"), ("8", "1.00", "phones", "product", None),
    ]


def test_a_first_order_delivered_again_keeps_its_flag(spark):
    state = spark.createDataFrame([("7", "1", 10), ("8", "1", None)], schemas.USER_STATE)
    again = spark.createDataFrame(
        [(10, 7, "2024-01-01"), (11, 7, "2024-01-02"), (12, 8, "2024-01-02"), (13, 9, "2024-01-02")],
        "id bigint, user_id bigint, create_time string",
    )
    assert rows(orders.flag_first_order(again, state), "id", "if_first_order") == [(10, "1"), (11, "0"), (12, "0"), (13, "1")]


def test_orders_keep_first_flag_over_batches(spark, folder):
    base = sample.order_info(spark, SMALL).persist()
    provinces, users = sample.base_province(spark, SMALL), queries._users(spark, SMALL)
    for name, dim in (("province", provinces), ("user", users)):
        ddl = schemas.BASE_PROVINCE if name == "province" else schemas.USER_DIM
        rows_at = dim.withColumn("changed_at", F.lit(at(0)).cast("timestamp"))
        jobs.dim_table(f"{folder}/{name}", ddl, "id").upsert(rows_at, "load", 0, ["changed_at"])
    cuts = ["", "1997-01-01", "1999-06-01", "9"]
    for low, high in zip(cuts, cuts[1:]):
        part = base.where((F.col("create_time") >= low) & (F.col("create_time") < high))
        send(to_records(part, "ODS_ORDER_INFO", timestamp=F.lit(at(1))), f"{folder}/ods")

    def play(checkpoint):
        source = topic(spark, "ODS_ORDER_INFO", f"{folder}/ods")
        job = jobs.enrich_orders(source, {"path": f"{folder}/dwd"}, f"{folder}/state", f"{folder}/province", f"{folder}/user")
        finish(job, "orders", checkpoint)
        return rows(decode(spark.read.parquet(f"{folder}/dwd"), schemas.ORDER_INFO_WIDE))

    expected = orders.order_info_wide(base, sample.empty_user_state(spark), provinces, users)
    assert play(f"{folder}/ck") == rows(expected)
    # A fresh checkpoint numbers from 0 again: what is there stays, and the flags of the same orders too.
    assert play(f"{folder}/ck-again") == rows(expected.unionAll(expected))
    state = jobs.user_state_table(f"{folder}/state").read(spark)
    assert rows(state, "user_id", "if_consumed", "first_order_id") == rows(
        orders.new_user_state(base, sample.empty_user_state(spark)), "user_id", "if_consumed", "first_order_id"
    )
    base.unpersist()


def test_a_fresh_checkpoint_over_new_records_keeps_what_is_stored(spark, folder):
    """Also: records that do not decode go to their own table."""
    for second, checkpoint in ((1, "ck"), (2, "ck-new")):
        values = [('{"tm_id": "%d", "tm_name": "n"}' % second,), ("no json",)]
        df = spark.createDataFrame(values, "value string")
        records = df.select(F.lit(None).cast("string").alias("key"), "value", F.lit(at(second)).cast("timestamp").alias("timestamp"), F.lit(f"T{second}").alias("topic"))
        send(records, f"{folder}/ods")
        source = lambda: topic(spark, f"T{second}", f"{folder}/ods")
        finish(jobs.maintain_trademark(source(), f"{folder}/tm"), "tm", f"{folder}/{checkpoint}")
        finish(jobs.keep_undecodable(source(), schemas.BASE_TRADEMARK, f"{folder}/bad-{second}"), "bad", f"{folder}/{checkpoint}")
        assert rows(spark.read.parquet(f"{folder}/bad-{second}"), "value") == [("no json",)]
    tm = jobs.read_dim(spark, f"{folder}/tm", "tm_id string, tm_name string", "tm_id")
    assert rows(tm) == [("1", "n"), ("2", "n")]
    assert read_table(spark, f"{folder}/tm").select("run").distinct().count() == 2


def order_pair(spark, seconds_per_line):
    heads = sample.with_order_arrival(queries._orders(spark, SMALL))
    lines = sample.with_detail_arrival(queries._details(spark, SMALL), seconds_per_line)
    return heads, lines


def test_long_join_allocates_like_batch(spark, folder):
    heads, lines = order_pair(spark, 140)
    send(to_records(heads, jobs.ORDER_TOPIC, "id", F.col("arrival")), f"{folder}/orders")
    send(to_records(lines, jobs.DETAIL_TOPIC, None, F.col("arrival")), f"{folder}/details")
    job = jobs.build_order_wide(
        read_topic(spark, jobs.ORDER_TOPIC, path=f"{folder}/orders"),
        read_topic(spark, jobs.DETAIL_TOPIC, path=f"{folder}/details"),
        f"{folder}/fact",
        {"path": f"{folder}/dws"},
        jobs.CACHE_WITHIN,
    )
    finish(job, "wide", f"{folder}/ck")
    expected = wide.allocate_amount(wide.join_orders_cache(heads, lines, hot=NONE_HOT), NONE_HOT)
    fact = read_table(spark, f"{folder}/fact").withColumn("dt", F.col("dt").cast("string"))
    columns = schemas.names(schemas.ORDER_WIDE)
    assert rows(fact, *columns) == rows(expected, *columns)
    whole = fact.groupBy("order_id").agg(
        F.sum(F.col("sku_price") * F.col("sku_num")).alias("lines"), F.max("original_total_amount").alias("original"),
        F.sum("final_detail_amount").alias("paid"), F.max("final_total_amount").alias("final"),
    ).where("lines = original")
    assert whole.count() > 100 and whole.where("paid <> final").count() == 0

    # The next hop: brand sums of the topic add up to the fact, also after a restart with nothing new.
    for checkpoint in ("ck-stat", "ck-stat"):
        records = read_topic(spark, jobs.WIDE_TOPIC, path=f"{folder}/dws")
        finish(jobs.sum_trademarks(records, f"{folder}/stat"), "stat", f"{folder}/{checkpoint}")
        totals = trademark.trademark_totals(read_table(spark, f"{folder}/stat").withColumn("tm_id", F.col("tm_id").cast("string")))
        direct = fact.groupBy(F.col("tm_id").cast("string").alias("tm_id"), "tm_name").agg(F.sum("final_detail_amount"))
        assert [tuple(map(str, r)) for r in rows(totals)] == [tuple(map(str, r)) for r in rows(direct)]


def test_window_join_over_batches_and_restart(spark, folder):
    """An order's lines arrive over several batches, one twice and one too late."""
    money = "decimal(18,2)"

    def order(i, second):
        df = spark.sql(
            f"SELECT {i}L id, 'P' order_status, '2024-01-01 00:00:00' create_time, '2024-01-01' create_date, 1L user_id, "
            f"CAST(100 AS {money}) original_total_amount, CAST(50 AS {money}) final_total_amount"
        )
        send(to_records(df, jobs.ORDER_TOPIC, "id", F.lit(at(second))), f"{folder}/orders")

    def line(i, order_id, price, second):
        df = spark.sql(f"SELECT {i}L id, {order_id}L order_id, CAST({price} AS {money}) order_price, 1L sku_num, 5L tm_id, 'A_B' tm_name")
        send(to_records(df, jobs.DETAIL_TOPIC, None, F.lit(at(second))), f"{folder}/details")

    def play():
        job = jobs.build_order_wide(
            topic(spark, jobs.ORDER_TOPIC, f"{folder}/orders"),
            topic(spark, jobs.DETAIL_TOPIC, f"{folder}/details"),
            f"{folder}/fact",
            {"path": f"{folder}/dws"},
        )
        finish(job, "wide", f"{folder}/ck")

    order(1, 0)
    line(11, 1, "33.33", 4)
    line(12, 1, "33.33", 9)
    line(12, 1, "33.33", 9)
    play()
    line(13, 1, "33.34", 14)
    line(14, 1, "1.00", 15)
    play()
    got = rows(read_table(spark, f"{folder}/fact"), "order_id", "order_detail_id", "final_detail_amount", "tm_name")
    assert [(o, d, str(a), n) for o, d, a, n in got] == [
        (1, 11, "16.67", "A_B"), (1, 12, "16.67", "A_B"), (1, 13, "16.66", "A_B"),
    ]
