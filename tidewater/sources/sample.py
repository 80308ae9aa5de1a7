"""The driver's sample tables seen as warehouse entities (mapping: FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater import schemas
from tidewater.functions.clock import epoch_millis, parse_time, text_time
from tidewater.operators.skew import HotKeys, only_keys
from tidewater.sources.tables import empty_table

AS_OF = "2024-01-01"
PRIOR_UNTIL = "1996-01-01"
REDELIVERY_SECONDS = 5


# Stated, so that opening a table starts no job to infer them.
TABLES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def as_of() -> Column:
    return F.lit(AS_OF).cast("date")


def _price(column: str) -> Column:
    return F.col(column).cast(schemas.MONEY)


def _text_id(text: Column) -> Column:
    """A number for a name: the first fifteen hex digits of its MD5, as many as a bigint holds."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10)


def _create_time() -> Column:
    offset = F.make_dt_interval(
        F.lit(0), (F.col("o_orderkey") % 24).cast("int"), (F.col("o_orderkey") % 60).cast("int"), F.lit(0)
    )
    return text_time(F.col("o_orderdate") + offset)


# --- logs -------------------------------------------------------------------


def _days(rows: DataFrame, at: str, start: str | None, end: str | None) -> DataFrame:
    """Rows whose time ``at`` lies on one of the days ``start`` to ``end``, compared with constants the scan can take."""
    if start is not None:
        rows = rows.where(F.col(at) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        rows = rows.where(F.col(at) < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz"))
    return rows


def app_logs(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Raw log lines of a range of days, all when open, with ``dt`` of the line for the archive."""
    e = _days(table(spark, sf_dir, "events"), "ts", start, end)
    common = F.struct(
        F.concat(F.lit("mid_"), F.col("user_id")).alias("mid"),
        F.col("user_id").cast("string").alias("uid"),
        (F.col("user_id") % 34).cast("string").alias("ar"),
        F.col("event_type").alias("ch"),
        F.get_json_object("props", "$.k").alias("vc"),
    )
    is_start = F.col("event_type").isin("signup", "view")
    start = F.when(is_start, F.struct(F.col("event_type").alias("entry")))
    line = F.struct(common.alias("common"), start.alias("start"), epoch_millis(F.col("ts")).alias("ts"))
    return e.select(F.to_json(line).alias("value"), F.col("ts").cast("date").cast("string").alias("dt"))


# --- dimensions -------------------------------------------------------------


def base_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("id"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").cast("string").alias("area_code"),
        F.concat(F.lit("N-"), F.col("n_nationkey")).alias("iso_code"),
        F.concat(F.lit("X-"), F.col("n_nationkey")).alias("iso_3166_2"),
    )


def _sku(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        _text_id(F.col("p_name")).alias("spu_id"),
        _price("p_retailprice").cast("string").alias("price"),
        F.col("p_name").alias("sku_name"),
        F.substring_index("p_brand", "#", -1).alias("tm_id"),
        _text_id(F.col("p_type")).alias("category3_id"),
        F.lit(AS_OF).alias("create_time"),
        F.col("p_type").alias("category3_name"),
        F.col("p_name").alias("spu_name"),
        F.col("p_brand").alias("tm_name"),
    )


def sku_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sku(spark, sf_dir).select(*schemas.names(schemas.SKU_INFO))


def sku_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SKU dimension as it is stored, names included."""
    return _sku(spark, sf_dir)


def base_category3(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _sku(spark, sf_dir).select(F.col("category3_id").alias("id"), F.col("category3_name").alias("name"))
    return c.distinct().withColumn("category2_id", F.lit("0"))


def base_trademark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sku(spark, sf_dir).select("tm_id", "tm_name").distinct()


def spu_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sku(spark, sf_dir).select(F.col("spu_id").alias("id"), "spu_name").distinct()


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = ((F.col("c_custkey") % 50 + 10) * 365).cast("int")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_mktsegment").alias("user_level"),
        F.date_sub(as_of(), days).cast("string").alias("birthday"),
        F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F").alias("gender"),
    )


def sku_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SKU price changes over time: every sale carries the price it was made at."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("id"),
        F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100 + 0.5).alias("price_cents"),
        F.col("l_shipdate").alias("changed_at"),
        F.col("l_orderkey").alias("change_id"),
        F.col("l_linenumber").alias("change_line"),
        F.col("l_suppkey").alias("source_id"),
    )


# --- facts ------------------------------------------------------------------


def _lineitem(spark: SparkSession, sf_dir: str, start: str | None, end: str | None) -> DataFrame:
    """Lines of the orders of some days, of all when open."""
    lines = table(spark, sf_dir, "lineitem")
    if start is None and end is None:
        return lines
    return only_keys(lines, "l_orderkey", _days(table(spark, sf_dir, "orders"), "o_orderdate", start, end).select("o_orderkey"))


def order_detail(
    spark: SparkSession, sf_dir: str, hot: HotKeys | None = None, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Order lines, of the orders of some days if given; the id is unique within an order and grows with the line number.

    Digits of the id: line number, SKU (11), ship day (4), repeat of the three (2).
    Where no order is known to dominate, the numbering shuffles by order, which
    a join on the order id that follows uses again.
    """
    line = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"]
    repeat = F.row_number().over(Window.partitionBy(*line).orderBy("l_suppkey", "l_quantity", "l_extendedprice"))
    ship_day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01").cast("date"))
    number = (
        F.col("l_linenumber") * F.lit(10**17)
        + F.col("l_partkey") * F.lit(10**6)
        + ship_day * F.lit(100)
        + F.col("_repeat")
    )
    part = table(spark, sf_dir, "part").select("p_partkey", _price("p_retailprice").alias("order_price"), "p_name")
    lineitem = _lineitem(spark, sf_dir, start, end)
    if hot is not None and not hot:
        lineitem = lineitem.repartition("l_orderkey")
    return (
        lineitem.withColumn("_repeat", repeat)
        .join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        .select(
            number.alias("id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("sku_id"),
            F.col("l_quantity").cast("bigint").alias("sku_num"),
            "order_price",
            F.col("p_name").alias("sku_name"),
            F.lit(None).cast("string").alias("create_time"),
            "l_linenumber",
            "l_returnflag",
        )
    )


def order_detail_keys(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Only the order id of every line: the cheapest scan to look for hot orders."""
    return _lineitem(spark, sf_dir, start, end).select(F.col("l_orderkey").alias("order_id"))


def order_info(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Order heads; the original total is the sum of the order's line amounts.

    ``start`` and ``end`` bound the order date, on which the order is created too: the added clock stays below a day.
    """
    part = table(spark, sf_dir, "part").select("p_partkey", _price("p_retailprice").alias("_price"))
    totals = (
        _lineitem(spark, sf_dir, start, end)
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey")
        .agg(F.sum(F.col("_price") * F.col("l_quantity").cast("bigint")).cast(schemas.MONEY).alias("_original"))
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("bigint"))
    return (
        _days(table(spark, sf_dir, "orders"), "o_orderdate", start, end)
        .join(totals, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .select(
            F.col("o_orderkey").alias("id"),
            F.col("c_nationkey").alias("province_id"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("o_custkey").alias("user_id"),
            _price("o_totalprice").alias("final_total_amount"),
            F.lit(0).cast(schemas.MONEY).alias("benefit_reduce_amount"),
            F.col("_original").alias("original_total_amount"),
            (F.col("o_orderkey") % 10).cast(schemas.MONEY).alias("feight_fee"),
            F.lit(None).cast("string").alias("expire_time"),
            _create_time().alias("create_time"),
            F.lit(None).cast("string").alias("operate_time"),
        )
    )


def _is_prior(orders: DataFrame) -> Column:
    return F.substring("create_time", 1, 10) < PRIOR_UNTIL


def prior_user_state(orders: DataFrame) -> DataFrame:
    """Users with an order before :data:`PRIOR_UNTIL` and the first such order."""
    first = _earliest(orders.where(_is_prior(orders)))
    return first.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.lit("1").alias("if_consumed"),
        F.col("_first.id").alias("first_order_id"),
    )


def _earliest(orders: DataFrame) -> DataFrame:
    return orders.groupBy("user_id").agg(F.min(F.struct("create_time", "id")).alias("_first"))


def order_batch(orders: DataFrame) -> DataFrame:
    """The orders that follow the prior state."""
    return orders.where(~_is_prior(orders))


def empty_user_state(spark: SparkSession) -> DataFrame:
    return empty_table(spark, schemas.USER_STATE)


# --- arrivals ---------------------------------------------------------------


def _arrival(order_id: Column, lag_seconds: Column) -> Column:
    """Orders arrive seven seconds apart over about a month; lines follow with a lag."""
    seconds = (order_id * 7) % 2_592_000 + lag_seconds
    return parse_time(F.lit("2024-01-01 00:00:00")) + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")
    )


def with_order_arrival(orders: DataFrame) -> DataFrame:
    return orders.withColumn("arrival", _arrival(F.col("id"), F.lit(0)))


def with_detail_arrival(details: DataFrame, seconds_per_line: int) -> DataFrame:
    """Lines arrive in line order; returned ones (flag R) arrive a second time a little later."""
    lag = F.col("l_linenumber") * seconds_per_line
    extra = F.when(F.col("l_returnflag") == "R", F.array(F.lit(0), F.lit(REDELIVERY_SECONDS))).otherwise(
        F.array(F.lit(0))
    )
    sent = details.withColumn("_again", F.explode(extra))
    return sent.withColumn("arrival", _arrival(F.col("order_id"), lag + F.col("_again"))).drop("_again")


def with_line_arrival(details: DataFrame, seconds_per_line: int) -> DataFrame:
    """Lines arrive in line order, each once."""
    lag = F.col("l_linenumber") * seconds_per_line
    return details.withColumn("arrival", _arrival(F.col("order_id"), lag))


# --- change records ---------------------------------------------------------


def _envelope(name: str, kind: Column, data: Column) -> Column:
    return F.to_json(F.struct(F.lit(name).alias("table"), kind.alias("type"), data.alias("data"))).alias("value")


def cdc_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records with one row each: facts, dimensions, and a table nobody takes.

    Urgent orders are control records whose row is empty.
    """
    urgent = F.col("o_orderpriority") == "1-URGENT"
    order_kind = F.when(F.col("o_orderstatus") == "P", "update").otherwise("insert")
    order_row = F.struct(F.when(~urgent, F.col("o_orderkey")).alias("id"))
    line_row = F.struct(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("id"))
    line_kind = F.when(F.col("l_returnflag") == "R", "delete").otherwise("insert")
    sku_kind = F.when(F.col("p_size") < 10, "delete").otherwise("update")
    parts = [
        table(spark, sf_dir, "orders").select(_envelope("order_info", order_kind, order_row)),
        table(spark, sf_dir, "lineitem").select(_envelope("order_detail", line_kind, line_row)),
        table(spark, sf_dir, "part").select(
            _envelope("sku_info", sku_kind, F.struct(F.col("p_partkey").alias("id")))
        ),
        table(spark, sf_dir, "customer").select(
            _envelope("user_info", F.lit("update"), F.struct(F.col("c_custkey").alias("id")))
        ),
        table(spark, sf_dir, "nation").select(
            _envelope("base_province", F.lit("bootstrap-insert"), F.struct(F.col("n_nationkey").alias("id")))
        ),
        table(spark, sf_dir, "events").select(
            _envelope("comment_info", F.lit("insert"), F.struct(F.col("event_id").alias("id")))
        ),
    ]
    return _union(parts)


def cdc_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records with lists of rows; every second line comes with a gift line."""
    order_row = F.array(F.struct(F.col("o_orderkey").alias("id")))
    order_kind = F.when(F.col("o_orderstatus") == "P", "UPDATE").otherwise("INSERT")
    sold = F.struct(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("id"))
    gift = F.struct(F.col("l_orderkey").alias("order_id"), (-F.col("l_linenumber")).alias("id"))
    line_rows = F.when(F.col("l_linenumber") % 2 == 0, F.array(sold, gift)).otherwise(F.array(sold))
    line_kind = F.when(F.col("l_returnflag") == "R", "DELETE").otherwise("INSERT")
    parts = [
        table(spark, sf_dir, "orders").select(_envelope("order_info", order_kind, order_row)),
        table(spark, sf_dir, "lineitem").select(_envelope("order_detail", line_kind, line_rows)),
        table(spark, sf_dir, "customer").select(
            _envelope("user_info", F.lit("INSERT"), F.array(F.struct(F.col("c_custkey").alias("id"))))
        ),
    ]
    return _union(parts)


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
