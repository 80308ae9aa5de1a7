"""One order with a third of all lines: same result, spread over many tasks."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewater.operators import skew, wide
from tidewater.operators.skew import SLICE, HotKeys, deal, hot_keys

N = 3000
MONEY = "decimal(18,2)"


@pytest.fixture(scope="module")
def tables(spark):
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 400 + 1000).cast("bigint")
    lines = spark.range(N).select(
        F.col("id") + 1, key.alias("order_id"), (F.col("id") % 5 + 1).alias("sku_num"),
        ((F.col("id") % 97) / 3).cast(MONEY).alias("order_price"),
    ).withColumnRenamed("(id + 1)", "id")
    totals = lines.groupBy("order_id").agg(F.sum(F.col("order_price") * F.col("sku_num")).cast(MONEY).alias("original_total_amount"))
    heads = totals.select(
        F.col("order_id").alias("id"), "original_total_amount",
        (F.col("original_total_amount") * 7 / 9).cast(MONEY).alias("final_total_amount"),
    )
    return heads, lines


def test_counts_find_the_hot_order(tables):
    hot = hot_keys(tables[1], "order_id", slice_rows=100)
    assert [tuple(r) for r in hot.table.collect()] == [(7, N // 3 // 100)]
    assert not hot_keys(tables[1], "order_id")


def test_no_rows_no_hot_keys(tables):
    assert not hot_keys(tables[1].limit(0), "order_id")


def test_slices_are_of_bounded_size(tables):
    hot = hot_keys(tables[1], "order_id", slice_rows=100)
    sizes = [r["count"] for r in deal(tables[1], hot, ["id"]).where("order_id = 7").groupBy(SLICE).count().collect()]
    assert len(sizes) == 10 and max(sizes) < 200


def test_sliced_allocation_equals_plain(tables):
    heads, lines = tables
    hot = hot_keys(lines, "order_id", slice_rows=100)
    none = HotKeys("order_id")

    def split(h):
        return wide.allocate_amount(wide.to_order_wide(wide.join_order_detail(heads, lines, h)), h)

    key = ("order_id", "order_detail_id", "final_detail_amount")
    sliced, plain = rows(split(hot), *key), rows(split(none), *key)
    assert sliced == plain and len(plain) == N
    sums = split(hot).groupBy("order_id").agg(F.sum("final_detail_amount").alias("s"), F.max("final_total_amount").alias("f"))
    assert sums.where("s <> f").count() == 0
    # A fact table that was joined elsewhere.
    stored = wide.to_order_wide(wide.join_order_detail(heads, lines, none))
    assert rows(wide.allocate_amount(stored, hot), *key) == plain


def test_sliced_window_join_equals_plain(spark, tables):
    heads, lines = tables
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    second = lambda n: F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), n.cast("decimal(18,6)"))
    heads = heads.withColumn("arrival", start + second(F.col("id") % 60))
    lines = lines.withColumn("arrival", start + second(F.col("order_id") % 60 + F.col("id") % 20))
    lines = lines.unionByName(lines.where("id % 2 = 0"))
    hot = hot_keys(lines, "order_id", slice_rows=100)
    for join in (wide.join_orders_window, wide.join_orders_cache):
        sliced = rows(join(heads, lines, hot=hot), "order_id", "order_detail_id", "sku_num")
        assert hot and sliced == rows(join(heads, lines, hot=HotKeys("order_id")), "order_id", "order_detail_id", "sku_num")
        assert len(sliced) == len(set(sliced))


def test_many_hot_keys_and_small_shares(spark):
    many = spark.range(1500 * 6).select((F.col("id") % 1500).alias("order_id"))
    assert hot_keys(many, "order_id", slice_rows=5).table.count() == 1500
    rare = spark.range(200_000).select(F.when(F.col("id") < 400, F.col("id") % 2).otherwise(F.col("id")).alias("order_id"))
    assert sorted(tuple(r) for r in hot_keys(rare, "order_id", slice_rows=150).table.collect()) == [(0, 2), (1, 2)]


def test_equal_arrivals_fall_alike_in_both_paths(spark, tables):
    heads, lines = tables
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    lines = lines.unionByName(lines.withColumn("sku_num", 9 - F.col("sku_num"))).withColumn("arrival", at)
    key = ("order_id", "order_detail_id", "sku_num")
    sliced = rows(wide.join_orders_window(heads.withColumn("arrival", at), lines, hot_keys(lines, "order_id", 100)), *key)
    assert sliced == rows(wide.join_orders_window(heads.withColumn("arrival", at), lines, HotKeys("order_id")), *key)
    assert len(sliced) == N and all(n <= 4 for _, _, n in sliced)


def test_surplus_lines_leave_the_completing_line_alone(spark):
    """The line that reaches the total takes the odd cent; a line beyond it gets its own share."""
    lines = [(7, i, p, 1, "50.00", "100.00") for i, p in enumerate(("33.33", "33.33", "33.34", "10.00"))]
    kind = "order_id long, order_detail_id long, sku_price string, sku_num long, final_total_amount string, original_total_amount string"
    df = spark.createDataFrame(lines, kind)
    df = df.withColumns({c: F.col(c).cast(MONEY) for c in ("sku_price", "final_total_amount", "original_total_amount")})
    for hot in (HotKeys("order_id"), hot_keys(df, "order_id", slice_rows=2)):
        split = wide.allocate_amount(df.withColumn("final_detail_amount", F.lit(0)), hot)
        assert [str(r[0]) for r in split.orderBy("order_detail_id").select("final_detail_amount").collect()] == ["16.67", "16.67", "16.66", "5.00"]


def test_sketch_and_exact_counts_find_the_same_keys(spark, monkeypatch):
    """Many near misses, keys of both kinds, nulls; the sketch loses none and adds none."""
    data = spark.range(200_000).select(
        F.when(F.col("id") % 10 == 0, 1).when(F.col("id") % 10 == 1, F.col("id") % 7 + 10).when(F.col("id") % 10 == 2, None)
        .otherwise(F.col("id") % 50_021 + 1000).cast("bigint").alias("k")
    ).withColumn("text", F.concat(F.lit("key "), "k"))
    for key in ("k", "text"):
        for slice_rows in (1000, 2857, 2858, 5000, 19_999, 20_000):
            counts = data.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") > slice_rows)
            want = sorted((r[key], -(-r["count"] // slice_rows)) for r in counts.collect())
            for tracked in (500_000, 0):
                monkeypatch.setattr(skew, "MOST_TRACKED", tracked)
                hot = hot_keys(data, key, slice_rows)
                assert (sorted(tuple(r) for r in hot.table.collect()) if hot else []) == want, (key, slice_rows, tracked)


def test_a_table_smaller_than_a_slice_is_only_counted(spark, monkeypatch):
    monkeypatch.setattr(skew.F, "call_function", None)
    assert not hot_keys(spark.range(100).selectExpr("1L AS k"), "k", 100)


def test_hot_orders_meet_in_ranges_that_the_allocation_goes_on_with(spark, tables):
    """Slices follow the line ids, also uneven ones, are about equal, and no line is dealt a second time."""
    heads, lines = tables
    lines = lines.withColumn("id", F.when(F.col("id") % 3 == 0, F.col("id") * 10**12).otherwise(F.col("id")))
    hot = hot_keys(lines, "order_id", slice_rows=100)
    joined = wide.join_order_detail(heads, lines, hot)
    found = joined.groupBy("order_id", SLICE).agg(F.min("order_detail_id").alias("a"), F.max("order_detail_id").alias("z"), F.count("*").alias("n"))
    slices = [tuple(r) for r in found.where("order_id = 7").orderBy(SLICE).select("a", "z", "n").collect()]
    assert len(slices) == 10 and max(n for _, _, n in slices) < 200 and sum(n for _, _, n in slices) == N // 3
    assert all(below[1] < above[0] for below, above in zip(slices, slices[1:]))
    assert found.where(f"order_id <> 7 AND {SLICE} > 0").count() == 0
    split = wide.allocate_amount(wide.to_order_wide(joined), hot)
    key = ("order_id", "order_detail_id", "final_detail_amount")
    none = HotKeys("order_id")
    assert rows(split, *key) == rows(wide.allocate_amount(wide.to_order_wide(wide.join_order_detail(heads, lines, none)), none), *key)
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan and "Union" not in plan


def test_ranges_of_few_and_equal_ids(spark):
    """Keys with fewer different ids than slices have fewer ranges; null ids come first; other keys stay whole."""
    data = [(1, i) for i in range(5)] + [(2, 3)] * 5 + [(3, None)] * 6 + [(4, 1), (4, 2)] + [(None, 7)] * 9 + [(5, None), *[(5, i) for i in range(8)]]
    df = spark.createDataFrame(data, "k long, id long")
    hot = hot_keys(df, "k", slice_rows=2)
    dealt = skew.deal_ranges(df, skew.ranges(df, hot, "id"), "id")
    got = dealt.groupBy("k", SLICE).agg(F.count("*"), F.max(skew.SLICES)).orderBy("k", SLICE).collect()
    assert [tuple(r) for r in got] == [
        (None, 0, 9, 1), (1, 0, 1, 3), (1, 1, 2, 3), (1, 2, 2, 3), (2, 0, 5, 1), (3, 0, 6, 1), (4, 0, 2, 1),
        (5, 0, 2, 5), (5, 1, 2, 5), (5, 2, 1, 5), (5, 3, 2, 5), (5, 4, 2, 5),
    ]
