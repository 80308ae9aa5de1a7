"""Tables in parts, running allocation, late rows, sliding sums and rollups: over batches, repeats and restarts."""

import glob
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows
from test_streaming import at, few_partitions, finish, send, topic  # noqa: F401
from tidewater import schemas
from tidewater.functions.clock import epoch_seconds
from tidewater.operators import trademark, wide
from tidewater.operators.skew import HotKeys
from tidewater.plans import batches, queries, reports, stored
from tidewater.operators import search, skew
from tidewater.sinks import pages, parts, tables
from tidewater.sinks.parts import PartTable
from tidewater.sinks.topics import kafka_sink_options, to_records, write_topic_batch
from tidewater.sources.tables import read_table
from tidewater.sources.topics import read_topic
from tidewater.streaming import jobs, state

ROW = "id string, name string, at int"


def table(folder, **more):
    return PartTable(f"{folder}/t", ROW, ("id",), **more)


def versions(spark, data):
    return spark.createDataFrame(data, ROW)


def put(spark, t, batch, data, run="r"):
    t.upsert(versions(spark, data), run, batch, ["at"])


def test_upsert_over_batches_repeats_and_a_new_run(spark, folder):
    t = table(folder)
    put(spark, t, 0, [("a", "old", 1), ("a", "new", 2), ("b", "b", 1), (None, "no id", 1)])
    put(spark, t, 1, [("a", "newest", 3), ("b", "older", 0), ("c", "c", 1)])
    want = [("a", "newest", 3), ("b", "b", 1), ("c", "c", 1), (None, "no id", 1)]
    assert rows(t.read(spark)) == want
    put(spark, t, 1, [("a", "newest", 3), ("b", "older", 0), ("c", "c", 1)])
    assert rows(t.read(spark)) == want
    assert rows(t.read(spark, before=("r", 1))) == [("a", "new", 2), ("b", "b", 1), (None, "no id", 1)]
    # A fresh checkpoint numbers from 0 again and goes on above what is there.
    put(spark, t, 0, [("a", "later", 4)], run="s")
    put(spark, t, 1, [("d", "d", 1)], run="s")
    put(spark, t, 1, [("d", "d", 1)], run="s")
    assert rows(t.read(spark)) == [("a", "later", 4), *want[1:3], ("d", "d", 1), want[3]]


def test_only_buckets_of_the_batch_are_read_and_written(spark, folder):
    t = table(folder)
    put(spark, t, 0, [(f"k{i}", "x", 1) for i in range(200)])
    assert len(t.listing(spark)) == t.buckets
    batch = versions(spark, [("k5", "y", 2)])
    assert t.parts_of(batch) == t.parts_of(versions(spark, [("k5", "z", 9)])) and len(t.parts_of(batch)) == 1
    put(spark, t, 1, [("k5", "y", 2)])
    assert sum(s.batch == 1 for s in t.listing(spark)) == 1
    some = t.read(spark, t.parts_of(batch))
    assert some.count() < 60 and len(some.inputFiles()) == 1
    assert t.read(spark).count() == 200


def test_sums_are_added_once(spark, folder):
    t = PartTable(f"{folder}/t", "month string, k string, n bigint", ("month", "k"), by="month")
    frame = lambda *data: spark.createDataFrame(data, "month string, k string, n bigint")
    for batch, data in ((0, [("1", "a", 1), ("2", "a", 2)]), (1, [("1", "a", 10), ("1", "b", 5)]), (1, [("1", "a", 10), ("1", "b", 5)]), (2, [("2", "a", 7)])):
        t.add(frame(*data), "r", batch)
    assert rows(t.read(spark), "month", "k", "n") == [("1", "a", 11), ("1", "b", 5), ("2", "a", 9)]
    plan = t.read(spark).where("month = '2'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_many_batches_leave_few_folders_and_fold_while_going_on(spark, folder):
    t = table(folder, buckets=2)
    rnd, want = random.Random(3), {}
    files = []
    for batch in range(30):
        data = [(f"k{rnd.randint(0, 40)}", f"v{batch}", batch)]
        put(spark, t, batch, data)
        want[data[0][0]] = (data[0][0], *data[0][1:])
        files.append(len(glob.glob(f"{folder}/t/**/*.parquet", recursive=True)))
    assert rows(t.read(spark)) == sorted(want.values())
    assert max(files) <= 2 * parts.KEEP and len(t.read(spark).inputFiles()) == 2
    assert len(glob.glob(f"{folder}/t/by=2/generation=*")) <= 2 * parts.KEEP


def test_an_unfinished_batch_does_not_count(spark, folder):
    t = table(folder, buckets=1)
    put(spark, t, 0, [("a", "x", 1)])
    put(spark, t, 1, [("a", "y", 2)])
    done = glob.glob(f"{folder}/t/by=1/generation=1/run=r/batch=1/_SUCCESS")
    files, path = parts._path(spark, done[0])
    files.delete(path, False)
    assert rows(t.read(spark)) == [("a", "x", 1)]
    put(spark, t, 1, [("a", "y", 2)])
    assert rows(t.read(spark)) == [("a", "y", 2)]


def test_another_number_of_buckets_fails(spark, folder):
    put(spark, table(folder), 0, [("a", "x", 1)])
    with pytest.raises(ValueError, match="stored otherwise"):
        table(folder, buckets=3).read(spark)


def test_empty_batches_and_an_absent_table(spark, folder):
    t = table(folder)
    assert rows(t.read(spark)) == []
    t.upsert(versions(spark, []), "r", 0, ["at"])
    assert rows(t.read(spark)) == [] and t.listing(spark) == []


@pytest.mark.parametrize("run", [None, "a"])
def test_compact_then_go_on(spark, folder, run):
    old, new = f"{folder}/old", f"{folder}/new"
    for batch, data in enumerate([[("a", "x", 1)], [("a", "y", 2), ("b", "b", 1)]]):
        tables.upsert_by_key(versions(spark, data), old, batch, ["id"], ["at"], run=run)
    tables.compact(spark, old, new, ["id"], ROW, ["at"])
    assert rows(tables.read_latest(spark, new, ["id"], ROW, ["at"])) == [("a", "y", 2), ("b", "b", 1)]
    tables.upsert_by_key(versions(spark, [("a", "z", 3)]), new, 2, ["id"], ["at"], run=run)
    assert rows(tables.read_latest(spark, new, ["id"], ROW, ["at"])) == [("a", "z", 3), ("b", "b", 1)]


# --- allocation over batches ----------------------------------------------------

FACT = (
    "order_id bigint, order_detail_id bigint, sku_price decimal(18,2), sku_num bigint, "
    "original_total_amount decimal(18,2), final_total_amount decimal(18,2), final_detail_amount decimal(18,2), arrival timestamp"
)


def lines_of(rnd, order, n, stated):
    """Lines of an order; ``stated`` adds to the total."""
    from decimal import Decimal

    prices = [Decimal(rnd.randint(0, 9999)) / 100 for _ in range(n)]
    total, paid = sum(prices) + stated, Decimal(rnd.randint(0, 99999)) / 100
    return [(order, i, p, 1, total, paid, Decimal(0), at(order % 7)) for i, p in enumerate(prices)]


def allocate_in_batches(spark, folder, batches, repeat=None, **more):
    sums, out = state.order_sums_table(f"{folder}/sums"), None
    for number, data in enumerate(batches):
        for _ in range(2 if number == repeat else 1):
            batch = spark.createDataFrame(data, FACT)
            split, totals = state.allocate_batch(batch, sums, "r", number, **more)
            split = split.select("order_id", "order_detail_id", "final_detail_amount").collect()
            sums.upsert(totals, "r", number, ["last_at"])
        out = (out or []) + split
    return sorted(tuple(r) for r in out)


@pytest.mark.parametrize("slice_rows", [1_000_000, 20])
def test_allocation_over_batches_equals_allocation_at_once(spark, folder, monkeypatch, slice_rows):
    """Right, too large and too small totals; one order holds most of a batch; one batch is repeated."""
    monkeypatch.setattr(state, "SLICE_ROWS", slice_rows)
    rnd = random.Random(11)
    data = [line for o in range(12) for line in lines_of(rnd, o, rnd.randint(1, 9), (0, 1, -3)[o % 3])] + lines_of(rnd, 99, 150, 0)
    batches = [[r for r in data if low <= r[1] < high] for low, high in ((0, 2), (2, 5), (5, 120), (120, 999))]
    got = allocate_in_batches(spark, folder, batches, repeat=2)
    whole = wide.allocate_amount(spark.createDataFrame(data, FACT), HotKeys("order_id"))
    assert got == sorted(tuple(r) for r in whole.select("order_id", "order_detail_id", "final_detail_amount").collect())
    assert sum(r[2] for r in got if r[0] == 99) == data[-1][5]


def test_sums_of_an_order_expire(spark, folder):
    from decimal import Decimal

    d = Decimal
    first = [(1, 1, d(50), 1, d(100), d(30), d(0), at(0))]
    second = [(1, 2, d(50), 1, d(100), d(30), d(0), at(500))]
    assert [str(r[2]) for r in allocate_in_batches(spark, f"{folder}/a", [first, second])] == ["15.00", "15.00"]
    got = allocate_in_batches(spark, f"{folder}/b", [first, second, [(1, 3, d(50), 1, d(100), d(30), d(0), at(2000))]], ttl_seconds=600)
    # Forgotten: the third line is the first of an order half paid, and completes nothing.
    assert [str(r[2]) for r in got] == ["15.00", "15.00", "15.00"]
    kept = rows(state.order_sums_table(f"{folder}/b/sums").read(spark), "amounts", "lines")
    assert kept == [(5000, 1)]


def test_batches_of_one_fact_are_not_dealt_by_order_again(spark, monkeypatch):
    """Rows lie in buckets of their order, so that windows and sums of a batch shuffle none of them."""
    plans, allocate = [], state.allocate_batch

    def seen(batch, sums, run, number):
        found = allocate(batch, sums, run, number)
        if number == 0:  # nothing is carried yet
            plans.extend(df._jdf.queryExecution().executedPlan().toString() for df in found)
        return found

    monkeypatch.setattr(batches, "allocate_batch", seen)
    tables_before = spark.catalog.listTables()
    got = queries.queries()["order_split_stored"](spark, SMALL)
    assert len(plans) == 2 and all("Window" in plans[0] and "Exchange" not in p for p in plans)
    assert rows(got) == rows(queries.queries()["order_split_partial"](spark, SMALL)) and spark.catalog.listTables() == tables_before


def test_upsert_shuffles_stored_rows_once(spark, folder, monkeypatch):
    """Also with several versions of a key in a batch, and keys stored before and not named again."""
    t, plans, rewrite = table(folder), [], PartTable.rewrite
    put(spark, t, 0, [(f"k{i}", "x", i % 7) for i in range(300)])
    batch = spark.range(900).selectExpr("CONCAT('k', id % 450) AS id", "CONCAT('y', id) AS name", "CAST(id % 5 AS INT) AS at")

    def seen(self, new, run, batch_id, fold, parts=None):
        def folded(*sides):
            plans.append(fold(*sides)._jdf.queryExecution().optimizedPlan().toString())
            return fold(*sides)

        rewrite(self, new, run, batch_id, folded, parts)

    monkeypatch.setattr(PartTable, "rewrite", seen)
    t.upsert(batch, "r", 1, ["at"], t.parts_of(batch))
    # Stored rows reach their part by the one exchange below which both sides meet.
    assert plans[0].index("RepartitionByExpression [bucket") < plans[0].index("Union")
    want = {f"k{i}": (f"k{i}", "x", i % 7) for i in range(300)}
    for i in range(900):
        key, new = f"k{i % 450}", (f"k{i % 450}", f"y{i}", i % 5)
        old = want.get(key)
        if old is None or (new[2], new[1]) > (old[2], old[1] if old[1] != "x" else ""):
            want[key] = new
    assert rows(t.read(spark)) == sorted(want.values())


# --- late rows ---------------------------------------------------------------------


def record(spark, name, seconds, values):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    return df.select(
        F.lit(None).cast("string").alias("key"), "value", F.lit(at(seconds)).cast("timestamp").alias("timestamp"), F.lit(name).alias("topic")
    )


def test_late_rows_go_to_their_own_table(spark, folder):
    ck, raw, out, late = (f"{folder}/{n}" for n in ("ck", "raw", "out", "late"))

    def play():
        finish(jobs.keep_late(topic(spark, "T", raw), "T_IN_TIME", {"path": out}, late, "15 seconds"), "gate", ck)

    for seconds, value in ((0, "a"), (20, "b"), (10, "c"), (5, "late"), (100, "d")):
        send(record(spark, "T", seconds, [value]), raw)
    play()
    send(record(spark, "T", 90, ["e"]), raw)
    send(record(spark, "T", 85, ["late too"]), raw)
    play()
    assert rows(spark.read.parquet(out), "value") == [("a",), ("b",), ("c",), ("d",), ("e",)]
    assert rows(read_table(spark, late), "value") == [("late",), ("late too",)]


def test_join_with_a_dominant_order_loses_nothing_and_shows_late_rows(spark, folder):
    """One order holds most lines of a batch; late lines are in the side table, all others in the fact."""
    money = "decimal(18,2)"
    ck, raw, gated, late, fact = (f"{folder}/{n}" for n in ("ck", "raw", "gated", "late", "fact"))

    def orders(ids, second):
        df = spark.createDataFrame([(i,) for i in ids], "id bigint").selectExpr(
            "id", "'P' order_status", "'2024-01-01 00:00:00' create_time", "'2024-01-01' create_date", "1L user_id",
            f"CAST(IF(id = 1, 400, 2) AS {money}) original_total_amount", f"CAST(IF(id = 1, 200, 1) AS {money}) final_total_amount",
        )
        send(to_records(df, jobs.ORDER_TOPIC, "id", F.lit(at(second))), f"{folder}/orders")

    def lines(pairs, second):
        df = spark.createDataFrame(pairs, "id bigint, order_id bigint").selectExpr(
            "id", "order_id", f"CAST(1 AS {money}) order_price", "1L sku_num", "5L tm_id", "'brand' tm_name"
        )
        send(to_records(df, jobs.DETAIL_TOPIC, None, F.lit(at(second))), raw)

    def play():
        finish(jobs.keep_late(topic(spark, jobs.DETAIL_TOPIC, raw), jobs.DETAIL_TOPIC, {"path": gated}, late, "15 seconds"), "gate", ck)
        job = jobs.build_order_wide(
            read_topic(spark, jobs.ORDER_TOPIC, path=f"{folder}/orders"),
            read_topic(spark, jobs.DETAIL_TOPIC, path=gated),
            fact, {"path": f"{folder}/dws"},
        )
        finish(job, "wide", ck)

    orders([1, 2], 0)
    lines([(i, 1) for i in range(300)] + [(1000, 2)], 4)
    play()
    lines([(300 + i, 1) for i in range(100)] + [(1001, 2)], 9)
    play()
    orders([3], 40)
    lines([(2000, 3)], 41)
    lines([(5000, 2)], 12)  # behind by more than the delay
    play()
    got = read_table(spark, fact)
    assert rows(got.groupBy("order_id").agg(F.count("*"), F.sum("final_detail_amount").cast("string"))) == [
        (1, 400, "200.00"), (2, 2, "1.00"), (3, 1, "0.50"),
    ]
    assert [r[0] for r in read_table(spark, late).select(F.get_json_object("value", "$.id")).collect()] == ["5000"]


def test_salted_join_spreads_an_order_over_its_shares(spark):
    schema = "id bigint, order_id bigint, timestamp timestamp"
    lines = spark.createDataFrame([(i, 1, at(0)) for i in range(4000)], schema)
    salts = lines.groupBy(F.pmod(F.xxhash64("id"), F.lit(state.SALTS))).count().collect()
    assert len(salts) == state.SALTS and max(r["count"] for r in salts) < 4000 / state.SALTS * 1.3


# --- sliding sums and rollups -----------------------------------------------------


def paid_lines(spark):
    fact = wide.allocate_amount(
        wide.to_order_wide(wide.join_order_detail(queries._orders(spark, SMALL), queries._details(spark, SMALL), HotKeys("order_id"))), HotKeys("order_id")
    )
    return fact.withColumn("arrival", sample_arrival())


def sample_arrival():
    seconds = (F.col("order_id") * 7) % 600 + F.floor(F.col("order_detail_id") / F.lit(10**17)) * 4
    return (F.lit(at(0)).cast("timestamp").cast("bigint") + seconds).cast("timestamp")


def test_streamed_windows_equal_batch_ones_over_restarts(spark, folder):
    fact = paid_lines(spark).persist()
    minute = F.minute("arrival")
    for low, high in ((0, 3), (3, 4), (4, 7), (7, 99)):
        part = fact.where((minute >= low) & (minute < high))
        send(records_at(part), f"{folder}/dws")
        source = topic(spark, jobs.WIDE_TOPIC, f"{folder}/dws")
        finish(jobs.slide_trademarks(source, f"{folder}/windows", "15 seconds"), "slide", f"{folder}/ck")
    # Something much later lets the watermark pass every window.
    last = records_at(fact.limit(1).withColumn("arrival", F.lit(at(9000)).cast("timestamp")))
    for _ in range(2):
        send(last, f"{folder}/dws")
        finish(jobs.slide_trademarks(topic(spark, jobs.WIDE_TOPIC, f"{folder}/dws"), f"{folder}/windows", "15 seconds"), "slide", f"{folder}/ck")
    columns = ["window_start", "window_end", "tm_id", "tm_name", "amount"]
    got = read_table(spark, f"{folder}/windows").where("window_start < '2024-01-01 01:00:00'")
    at_seconds = epoch_seconds(F.col("arrival").cast("timestamp_ntz"))
    want = trademark.sliding_amount(fact, at_seconds, wide.WINDOW_SECONDS, wide.SLIDE_SECONDS)
    assert want.count() > 1000
    assert rows(got.withColumn("tm_id", F.col("tm_id").cast("string")), *columns) == rows(want, *columns)
    fact.unpersist()


def records_at(part):
    return part.select(
        F.lit(None).cast("string").alias("key"),
        F.to_json(F.struct(*schemas.names(schemas.ORDER_WIDE))).alias("value"),
        F.col("arrival").alias("timestamp"),
        F.lit(jobs.WIDE_TOPIC).alias("topic"),
    )


def test_rollup_of_a_stream_serves_what_the_fact_gives(spark, folder):
    fact = paid_lines(spark).persist()
    late = F.col("order_id") % 10 == 3
    for part in (fact.where(~late & (F.col("dt") < "1996-01-01")), fact.where(~late & (F.col("dt") >= "1996-01-01")), fact.where(late)):
        send(records_at(part), f"{folder}/dws")
        finish(jobs.roll_up_orders(topic(spark, jobs.WIDE_TOPIC, f"{folder}/dws"), f"{folder}/rollup"), "rollup", f"{folder}/ck")
    t = stored.order_rollup(f"{folder}/rollup")
    day = fact.groupBy("dt").count().orderBy(F.desc("count"), "dt").first()["dt"]
    assert rows(stored.order_total(t, spark, day)) == rows(reports.order_total(fact, day))
    assert rows(stored.order_hour(t, spark, day)) == rows(reports.order_hour(fact, day))
    assert rows(stored.order_total(t, spark, "2050-01-01").select(F.col("amount").cast("string"))) == [("0.00",)]
    stat = trademark.trademark_batch_stat(fact.withColumn("clock", F.col("create_time")), F.col("clock"))
    assert rows(stored.trademark_topn(t, spark, "1995-01-01", "1995-12-31")) == rows(trademark.trademark_topn(stat, "1995-01-01", "1995-12-31"))
    plan = stored.order_hour(t, spark, day)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert f"(month#" in scan and f"= {day[:7]})" in scan.replace(">= ", "= ") and f"GreaterThanOrEqual(dt,{day})" in scan
    fact.unpersist()


@pytest.mark.parametrize("name", ["order_total_stored", "order_hour_stored", "trademark_range_stored", "dau_total_stored"])
def test_stored_reports_read_their_months_only(spark, name):
    plan = queries.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line or "PartitionFilters" in line]
    assert scans and all("PartitionFilters: [isnotnull(month" in s for s in scans)


# --- records sent again ---------------------------------------------------------------


def test_a_batch_sent_twice_reaches_a_stream_once(spark, folder):
    """Also records of equal content in one batch, or in two, all stay."""
    sent, out, ck = f"{folder}/sent", f"{folder}/out", f"{folder}/ck"

    def write(batch, values, run="r"):
        write_topic_batch(record(spark, "T", batch, values), batch, job="j", run=run, path=sent)

    def play():
        source = read_topic(spark, "T", path=sent, once_within="10 minutes")
        finish(source.writeStream.format("parquet").option("path", out), "copy", ck)

    write(0, ["a", "a", "b"])
    write(1, ["a", "c"])
    play()
    write(1, ["c", "a"])  # again, in another order and other files
    write(2, ["d"])
    play()
    play()
    assert rows(spark.read.parquet(out), "value") == [("a",), ("a",), ("a",), ("b",), ("c",), ("d",)]
    assert read_table(spark, sent).select("record_id").distinct().count() == 6


# --- search by index, pages -------------------------------------------------------------


def test_index_search_equals_search(spark, folder):
    names = ["red  apple", "RED-red", "blue", "", None, "über red!", "apple pie", "blue apple"]
    data = spark.createDataFrame([(i, n, i % 3) for i, n in enumerate(names)], "id bigint, name string, price int")
    t = PartTable(f"{folder}/rows", "id bigint, name string, price int", ("id",))
    t.upsert(data, "r", 0, ["id"])
    search.write_index(data, "name", "id", ["price", "id"], f"{folder}/index")
    for keyword in ("red", "Red apple", "über", "none", "red red", "apple, BLUE"):
        for start, size in ((0, 20), (1, 2), (50, 5)):
            got = search.search_page(spark, f"{folder}/index", t, keyword, ["price", "id"], start, size)
            want = reports.search_page(data, "name", keyword, ["price", "id"], start, size)
            assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()], (keyword, start)
    plan = search.read_index(spark, f"{folder}/index", "red")._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "bucket#" in scan.split("PushedFilters")[0] and "EqualTo(term,red)" in scan.replace("In(term, [red])", "EqualTo(term,red)")


def files_named(df):
    """How many files the partition filter lets through."""
    scan = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", df._jdf.queryExecution().executedPlan().toString(), re.S)[1]
    if found := re.search(r"file#\d+L? IN \(([^)]*)\)", scan):
        return len(found[1].split(","))
    return len(re.findall(r"file#\d+L? = \d+", scan)) or 99


def test_pages_equal_offsets_and_read_their_files_only(spark, folder):
    data = spark.range(1000).selectExpr("id * 7 % 1000 AS n", "CAST(id * 7 % 1000 DIV 10 AS STRING) AS day", "id")
    sort = ["day", "n"]
    pages.write_sorted(data, folder, sort, file_rows=100)
    every = [tuple(r) for r in data.orderBy(*sort).select("n", "day", "id").collect()]
    last = None
    for number in range(1, 36):
        want = every[(number - 1) * 30 : number * 30]
        by_number, after = pages.page(spark, folder, sort, number, 30), pages.page_after(spark, folder, sort, last, 30)
        assert [tuple(r) for r in by_number.select("n", "day", "id").collect()] == want
        assert [tuple(r) for r in after.select("n", "day", "id").collect()] == want
        if want:
            assert files_named(by_number) <= 2 and files_named(after) <= 3
            last = (want[-1][1], want[-1][0])


def test_pages_of_nothing(spark, folder):
    pages.write_sorted(spark.createDataFrame([], "a int, b int"), folder, ["a"])
    assert pages.page(spark, folder, ["a"], 1, 5).collect() == [] and pages.page_after(spark, folder, ["a"], [3], 5).collect() == []


# --- lines of some days only ----------------------------------------------------------------


@pytest.mark.parametrize("name", ["order_total_day", "order_hour_day", "hour_compare_day", "trademark_topn_range"])
def test_lines_of_other_days_are_dropped_before_their_exchange(spark, name):
    plan = queries.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    scans = [i for i, line in enumerate(plan) if "FileScan parquet" in line and "l_orderkey" in line]
    assert scans
    for i in scans:
        # Going up from a scan of the lines, the join with the day's ids comes before any exchange.
        level = depth(plan[i])
        for line in reversed(plan[:i]):
            if depth(line) < level:
                level = depth(line)
                assert "Exchange" not in line
                if "LeftSemi" in line:
                    break
        else:
            raise AssertionError("no semi-join over the lines")


def test_many_wanted_keys_are_joined_by_a_shuffle(spark, monkeypatch):
    lines = spark.range(100).withColumnRenamed("id", "k")
    wanted = spark.createDataFrame([(3,), (3,), (5,), (None,)], "x bigint")
    few = skew.only_keys(lines, "k", wanted)
    monkeypatch.setattr(skew, "FEW_KEYS", 1)
    many = skew.only_keys(lines, "k", wanted)
    assert rows(few) == rows(many) == [(3,), (5,)]
    assert "ResolvedHint (strategy=broadcast)" in few._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in many._jdf.queryExecution().analyzed().toString()
