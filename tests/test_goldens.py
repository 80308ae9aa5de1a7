"""Hand-computed results on tables of a few rows."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewater import schemas
from tidewater.functions.labels import age_group, age_on
from tidewater.functions.money import round_half_up
from tidewater.operators import dau, dims, orders, routing, trademark, wide
from tidewater.operators.skew import HotKeys
from tidewater.plans import reports
from tidewater.sources.decode import decode, undecodable

NONE_HOT = HotKeys("order_id")


def fact(spark, lines):
    """Fact rows from (order, line, price, number, original, final)."""
    money = "decimal(18,2)"
    return spark.createDataFrame(
        [(o, i, D(p), n, D(orig), D(fin), D(0)) for o, i, p, n, orig, fin in lines],
        f"order_id bigint, order_detail_id bigint, sku_price {money}, sku_num bigint, "
        f"original_total_amount {money}, final_total_amount {money}, final_detail_amount {money}",
    )


def shares(df):
    return [r[0] for r in df.orderBy("order_id", "order_detail_id").select("final_detail_amount").collect()]


@pytest.mark.parametrize(
    "lines, expected",
    [
        # Lines complete the order: the last one takes what is left.
        (
            [(1, 1, "33.33", 1, "100.00", "50.00"), (1, 2, "33.33", 1, "100.00", "50.00"), (1, 3, "33.34", 1, "100.00", "50.00")],
            ["16.67", "16.67", "16.66"],
        ),
        ([(1, 1, "20.00", 1, "20.00", "18.50")], ["18.50"]),
        # A line is missing: no line is last.
        ([(1, 1, "40.00", 1, "100.00", "80.00")], ["32.00"]),
        # The paid amount may be zero, the original total too.
        ([(1, 1, "1.00", 2, "2.00", "0.00")], ["0.00"]),
        ([(1, 1, "0.00", 1, "0.00", "7.00"), (1, 2, "0.00", 1, "0.00", "7.00")], ["7.00", "0.00"]),
        # A free gift after the completing line takes nothing.
        ([(1, 1, "3.00", 1, "9.00", "1.00"), (1, 2, "6.00", 1, "9.00", "1.00"), (1, 3, "0.00", 1, "9.00", "1.00")], ["0.33", "0.67", "0.00"]),
        # Amounts too large for a bigint product.
        ([(1, 1, "90000000000.00", 1, "270000000000.00", "100000000000.00"), (1, 2, "90000000000.00", 2, "270000000000.00", "100000000000.00")],
         ["33333333333.33", "66666666666.67"]),
    ],
)
def test_allocation(spark, lines, expected):
    assert shares(wide.allocate_amount(fact(spark, lines), NONE_HOT)) == [D(x) for x in expected]


def test_allocation_without_original_total(spark):
    df = fact(spark, [(1, 1, "5.00", 1, "5.00", "4.00")]).withColumn(
        "original_total_amount", F.lit(None).cast("decimal(18,2)")
    )
    assert shares(wide.allocate_amount(df, NONE_HOT)) == [D("0.00")]


def test_allocation_looks_for_hot_orders_itself(spark):
    df = fact(spark, [(1, 1, "20.00", 1, "20.00", "18.50")])
    assert shares(wide.allocate_amount(df)) == [D("18.50")]
    assert shares(wide.allocate_amount(df.limit(0))) == []


def test_rounding_ties_go_up(spark):
    df = spark.sql("SELECT 0.125D AS a, -0.125D AS b").select(round_half_up(F.col("a")), round_half_up(F.col("b")))
    assert tuple(df.first()) == (0.13, -0.12)


def test_age_bands(spark):
    born = ["2004-01-12", "2004-01-02", "1993-01-09", "1993-01-08", None]
    df = spark.createDataFrame([(b,) for b in born], "b string")
    age = age_on(F.col("b"), F.lit("2024-01-01"))
    assert [tuple(r) for r in df.select(age, age_group(age)).collect()] == [
        (19, "20岁及以下"),
        (20, "21岁到30岁"),
        (30, "21岁到30岁"),
        (31, "30岁以上"),
        (None, None),
    ]


def test_gender(spark):
    users = spark.createDataFrame([("1", "a", "2000-01-01", g) for g in ("M", "F", None)], schemas.USER_INFO)
    names = [r.gender_name for r in dims.derive_user(users, F.lit("2024-01-01")).collect()]
    assert names == ["男", "女", "女"]


def test_first_order(spark):
    at = "2024-01-01 10:00:0"
    batch = spark.createDataFrame(
        [(11, 1, at + "5"), (10, 1, at + "5"), (12, 1, at + "9"), (20, 2, at + "1"), (21, 2, at + "2"), (30, 3, at + "1")],
        "id bigint, user_id bigint, create_time string",
    )
    state = spark.createDataFrame([("2", "1", 5), ("3", "0", None)], schemas.USER_STATE)
    assert rows(orders.flag_first_order(batch, state), "id", "if_first_order") == [
        (10, "1"), (11, "0"), (12, "0"), (20, "0"), (21, "0"), (30, "1"),
    ]
    assert rows(orders.upsert_user_state(batch, state)) == [("1", "1", 10), ("2", "1", 5), ("3", "1", 30)]


def test_order_time(spark):
    df = spark.createDataFrame([("2020-07-31 09:05:01",), ("2020-07-31",), (None,)], "create_time string")
    assert [tuple(r)[1:] for r in orders.derive_order_time(df).collect()] == [
        ("2020-07-31", "09"), ("2020-07-31", None), (None, None),
    ]


def test_missing_dimension_row(spark):
    details = spark.createDataFrame([(1, 7), (2, 8)], "id bigint, sku_id bigint")
    skus = spark.createDataFrame([("7", "1", "2", "3", "s", "t", "c")],
                                 "id string, spu_id string, tm_id string, category3_id string, spu_name string, tm_name string, category3_name string")
    assert rows(orders.join_sku(details, skus), "id", "tm_id", "tm_name") == [(1, 2, "t"), (2, None, None)]
    assert dims.unmatched_count(details, skus, "sku_id", "id").first()[0] == 1
    with pytest.raises(Exception, match="no row for sku_id 8"):
        orders.join_sku(details, skus, strict=True).collect()


def test_daily_devices(spark):
    def ms(day, hour):
        return int(dt.datetime(2024, 1, day, hour, tzinfo=dt.timezone.utc).timestamp() * 1000)

    logs = spark.createDataFrame(
        [((m, "u", "a", "c", "v"), ms(d, h)) for m, d, h in [("a", 1, 2), ("a", 1, 1), ("a", 2, 1), ("b", 1, 3)]],
        schemas.START_LOG,
    )
    once = dau.dedup_daily(dau.to_dau_info(logs))
    assert rows(once, "mid", "dt", "hr", "mi") == [
        ("a", "2024-01-01", "01", "00"), ("a", "2024-01-02", "01", "00"), ("b", "2024-01-01", "03", "00"),
    ]
    assert rows(dau.dau_total(once, "2024-01-01")) == [("2024-01-01", 2)]
    shanghai = dau.to_dau_info(logs.limit(1), "Asia/Shanghai")
    assert rows(shanghai, "dt", "hr") == [("2024-01-01", "10")]


def test_hour_compare(spark):
    hourly = spark.createDataFrame([("2024-01-02", "09", 100), ("2024-01-02", "13", 50)], "dt string, hr string, n bigint")
    day = reports.hour_compare(hourly, "n", "2024-01-02").orderBy("hr").collect()
    assert [r.hr for r in day] == [f"{h:02d}" for h in range(24)]
    assert {r.hr: r.today for r in day if r.today} == {"09": 100, "13": 50}
    assert all(r.yesterday == 0 for r in day)
    after = reports.hour_compare(hourly, "n", "2024-01-03").collect()
    assert {r.hr: (r.today, r.yesterday) for r in after if r.yesterday} == {"09": (0, 100), "13": (0, 50)}


def test_totals_of_one_day(spark):
    wide_rows = spark.createDataFrame([("2024-01-01", D("3.10")), ("2024-01-01", D("1.00"))], "dt string, final_detail_amount decimal(18,2)")
    assert rows(reports.order_total(wide_rows, "2024-01-01")) == [("2024-01-01", D("4.10"))]
    assert rows(reports.order_total(wide_rows, "2024-01-09")) == [("2024-01-09", D("0.00"))]
    devices = spark.createDataFrame([("2024-01-01", 5)], "dt string, total bigint")
    panel = reports.realtime_total(devices, reports.order_total(wide_rows), "2024-01-01")
    assert rows(panel, "id", "value") == [("dau", D("5.00")), ("order_amount", D("4.10"))]
    none = reports.realtime_total(devices, reports.order_total(wide_rows), "2030-01-01")
    assert rows(none, "id", "value") == [("dau", D("0.00")), ("order_amount", D("0.00"))]


def test_change_objects(spark):
    records = [
        '{"table":"order_info","type":"insert","data":{"id":1,"n":{"x":[1,2]}}}',
        '{"table":"order_info","type":"update","data":{"id":2}}',
        '{"table":"user_info","type":"update","data":{"id":3}}',
        '{"table":"user_info","type":"update","data":{}}',
        '{"table":"user_info","type":"update"}',
        '{"table":"comment_info","type":"insert","data":{"id":4}}',
        "no json",
    ]
    df = spark.createDataFrame([(r,) for r in records], "value string")
    assert rows(routing.route_cdc_object(df)) == [
        ("ODS_ORDER_INFO", '{"id":1,"n":{"x":[1,2]}}'), ("ODS_USER_INFO", '{"id":3}'),
    ]


def test_change_arrays(spark):
    records = [
        '{"table":"order_detail","type":"INSERT","data":[{"id":1},{"id":2}]}',
        '{"table":"order_detail","type":"UPDATE","data":[{"id":3}]}',
        '{"table":"user_info","type":"INSERT","data":[{"id":4}]}',
        '{"table":"order_info","type":"INSERT","data":[]}',
    ]
    df = spark.createDataFrame([(r,) for r in records], "value string")
    assert rows(routing.route_cdc_array(df)) == [("ODS_ORDER_DETAIL", '{"id":1}'), ("ODS_ORDER_DETAIL", '{"id":2}')]


def test_log_route(spark):
    df = spark.createDataFrame([('{"start":{"x":1}}',), ('{"start":""}',), ("{}",)], "value string")
    assert [r.topic for r in routing.route_app_log(df).collect()] == ["APP_START", "APP_EVENT", "APP_EVENT"]


def test_decode_keeps_bad_records_apart(spark):
    df = spark.createDataFrame([('{"id":"1","spu_name":"a","more":2}',), ("broken",), (None,)], "value string")
    assert rows(decode(df, schemas.SPU_INFO)) == [("1", "a")]
    assert rows(undecodable(df, schemas.SPU_INFO)) == [("broken",), (None,)]


def test_trademark_names_stay_whole(spark):
    df = spark.createDataFrame([(5, "A_B", D("1.10")), (5, "A_B", D("2.20"))], "tm_id bigint, tm_name string, final_detail_amount decimal(18,2)")
    stat = trademark.trademark_batch_stat(df, F.lit("2022-03-04 05:06:07"))
    assert rows(stat) == [("2022-03-04", "2022-03-04 05:06:07", "5", "A_B", D("3.30"))]
    assert rows(trademark.to_datav(trademark.trademark_topn(stat, "2022-03-04", "2022-03-04"))) == [("A_B", D("3.30"), "1")]
    assert trademark.trademark_topn(stat, "2022-03-05").count() == 0


def test_window_join(spark):
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    heads = spark.createDataFrame([(1, at(1))], "id bigint, arrival timestamp_ntz")
    lines = spark.createDataFrame(
        [(10, 1, at(4)), (12, 1, at(14)), (12, 1, at(14)), (12, 1, at(13)), (13, 1, at(15))],
        "id bigint, order_id bigint, arrival timestamp_ntz",
    )
    assert rows(wide.join_orders_window(heads, lines), "order_id", "order_detail_id") == [(1, 10), (1, 12)]


def test_cache_join(spark):
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    heads = spark.createDataFrame([(1, at(1000))], "id bigint, arrival timestamp_ntz")
    lines = spark.createDataFrame(
        [(10, 1, at(401)), (11, 1, at(1599)), (11, 1, at(1599)), (12, 1, at(1600)), (13, 2, at(1000))],
        "id bigint, order_id bigint, arrival timestamp_ntz",
    )
    assert rows(wide.join_orders_cache(heads, lines), "order_id", "order_detail_id") == [(1, 10), (1, 11)]


def test_search(spark):
    df = spark.createDataFrame([(1, "red ring"), (2, "Big RED-bolt"), (3, "reddish"), (4, "blue"), (5, "red")], "id int, name string")
    assert rows(reports.search_page(df, "name", "Red shoe", ["id"], 1, 2)) == [(2, "Big RED-bolt"), (5, "red")]
    assert reports.search_page(df, "name", " ", ["id"]).count() == 5
