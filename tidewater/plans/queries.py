"""The registered queries: every warehouse operator over the whole sample tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater import schemas
from tidewater.functions.clock import epoch_seconds, parse_time, text_time
from tidewater.operators import dau as dau_ops
from tidewater.operators import dims, orders, routing, search, trademark, wide
from tidewater.operators.skew import HotKeys, hot_keys
from tidewater.plans import batches, reports, stored
from tidewater.sinks import pages
from tidewater.sinks.parts import PartTable
from tidewater.sinks.tables import latest_by_key
from tidewater.sources import sample
from tidewater.sources.decode import decode

BATCH_SECONDS = 5
SEARCH_WORD = "red"
SEARCH_SIZE = 20
SEARCH_FROM = 5
# Day and range of the reports that answer for some days only.
LOG_DAY = "2024-01-15"
ORDER_DAY, DAY_BEFORE = "1996-09-17", "1996-09-16"
SALES_FROM, SALES_TO = "1996-07-01", "1996-12-31"
# Lines from which ``order_split_sliced`` counts an order as dominant.
FEW_LINES = 4
# Rows of a file of the stored pages.
PAGE_FILE_ROWS = 5000


def _doubles(df: DataFrame) -> DataFrame:
    """Money as double at the edge, so any client compares it alike."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# --- building blocks --------------------------------------------------------


def _dau(spark: SparkSession, sf: str, start: str | None = None, end: str | None = None) -> DataFrame:
    starts = routing.route_app_log(sample.app_logs(spark, sf, start, end)).where(F.col("topic") == routing.START_TOPIC)
    return dau_ops.dedup_daily(dau_ops.to_dau_info(decode(starts, schemas.START_LOG)))


def _users(spark: SparkSession, sf: str) -> DataFrame:
    return dims.derive_user(sample.user_info(spark, sf), sample.as_of())


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return orders.order_info_wide(
        sample.order_info(spark, sf),
        sample.empty_user_state(spark),
        sample.base_province(spark, sf),
        _users(spark, sf),
    )


def _hot(spark: SparkSession, sf: str, start: str | None = None, end: str | None = None) -> HotKeys:
    return hot_keys(sample.order_detail_keys(spark, sf, start, end), "order_id")


def _details(
    spark: SparkSession, sf: str, hot: HotKeys | None = None, start: str | None = None, end: str | None = None
) -> DataFrame:
    return orders.join_sku(sample.order_detail(spark, sf, hot, start, end), sample.sku_dim(spark, sf))


def _wide(heads: DataFrame, lines: DataFrame, hot: HotKeys) -> DataFrame:
    """Order fact before allocation from order and line rows."""
    return wide.to_order_wide(wide.join_order_detail(heads, lines, hot))


def _allocated(
    spark: SparkSession, sf: str, lines: DataFrame, hot: HotKeys, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Allocated lines with the order's calendar fields and no further order attributes."""
    heads = orders.derive_order_time(sample.order_info(spark, sf, start, end))
    return wide.allocate_amount(_wide(heads, lines, hot), hot)


def _paid(spark: SparkSession, sf: str, start: str | None = None, end: str | None = None) -> DataFrame:
    hot = _hot(spark, sf, start, end)
    return _allocated(spark, sf, sample.order_detail(spark, sf, hot, start, end), hot, start, end)


def _partly_stated(spark: SparkSession, sf: str, lines: DataFrame) -> DataFrame:
    """Order heads whose stated totals are 1.00 too large, lack the last line, or are right, in turn."""
    last = lines.groupBy("order_id").agg(F.max_by(F.col("order_price") * F.col("sku_num"), "id").alias("_last"))
    turn, total = F.col("id") % 3, F.col("original_total_amount")
    stated = F.when(turn == 0, total + 1).when(turn == 1, total - F.col("_last")).otherwise(total)
    heads = orders.derive_order_time(sample.order_info(spark, sf)).join(last, F.col("id") == F.col("order_id"), "left")
    return heads.withColumn("original_total_amount", stated.cast(schemas.MONEY)).drop("_last", "order_id")


_SPLIT = ["order_id", "order_detail_id", "original_total_amount", "final_detail_amount"]


def _partly_paid(spark: SparkSession, sf: str, hot: HotKeys) -> DataFrame:
    lines = sample.order_detail(spark, sf, hot)
    heads = _partly_stated(spark, sf, lines)
    return wide.allocate_amount(_wide(heads, lines, hot), hot).select(*_SPLIT)


def _stat(spark: SparkSession, sf: str, start: str | None = None, end: str | None = None) -> DataFrame:
    created = epoch_seconds(parse_time(F.col("create_time")))
    bucket = F.floor(created / BATCH_SECONDS) * BATCH_SECONDS
    clock = text_time(parse_time(F.lit("1970-01-01")) + F.make_dt_interval(secs=bucket.cast("decimal(18,6)")))
    hot = _hot(spark, sf, start, end)
    return trademark.trademark_batch_stat(_allocated(spark, sf, _details(spark, sf, hot, start, end), hot, start, end), clock)


def _sales(spark: SparkSession, sf: str) -> DataFrame:
    """Order fact with user attributes, not allocated."""
    heads = orders.derive_order_time(sample.order_info(spark, sf))
    heads = orders.join_user(heads, _users(spark, sf))
    hot = _hot(spark, sf)
    return _wide(heads, _details(spark, sf, hot), hot)


# --- queries ----------------------------------------------------------------


def app_log_route(spark: SparkSession, sf: str) -> DataFrame:
    routed = routing.route_app_log(sample.app_logs(spark, sf))
    return routed.groupBy("topic", "dt").agg(F.count("*").alias("records"))


def raw_log_archive_counts(spark: SparkSession, sf: str) -> DataFrame:
    return sample.app_logs(spark, sf).groupBy("dt").agg(F.count("value").alias("records"))


def dau_detail(spark: SparkSession, sf: str) -> DataFrame:
    return _dau(spark, sf)


def dau_total(spark: SparkSession, sf: str) -> DataFrame:
    return dau_ops.dau_total(_dau(spark, sf))


def dau_total_day(spark: SparkSession, sf: str) -> DataFrame:
    return dau_ops.dau_total(_dau(spark, sf, LOG_DAY, LOG_DAY), LOG_DAY)


def dau_hour(spark: SparkSession, sf: str) -> DataFrame:
    return dau_ops.dau_hour(_dau(spark, sf))


def dau_hour_compare(spark: SparkSession, sf: str) -> DataFrame:
    return reports.hour_compare(dau_ops.dau_hour(_dau(spark, sf)), "total")


def _routed_ids(routed: DataFrame) -> DataFrame:
    return routed.select(
        "topic",
        F.get_json_object("value", "$.order_id").alias("order_id"),
        F.get_json_object("value", "$.id").alias("id"),
    )


def cdc_object_route(spark: SparkSession, sf: str) -> DataFrame:
    return _routed_ids(routing.route_cdc_object(sample.cdc_objects(spark, sf)))


def cdc_array_route(spark: SparkSession, sf: str) -> DataFrame:
    return _routed_ids(routing.route_cdc_array(sample.cdc_arrays(spark, sf)))


def dim_province(spark: SparkSession, sf: str) -> DataFrame:
    return dims.build_dim(sample.base_province(spark, sf), "id", ["name"])


def dim_category3(spark: SparkSession, sf: str) -> DataFrame:
    return dims.build_dim(sample.base_category3(spark, sf), "id", ["name"])


def dim_trademark(spark: SparkSession, sf: str) -> DataFrame:
    rows = sample.base_trademark(spark, sf).select(
        F.lit(None).cast("string").alias("tm_id"), F.col("tm_id").alias("id"), "tm_name"
    )
    return dims.build_dim(dims.trademark_key(rows), "tm_id", ["tm_name"])


def dim_spu(spark: SparkSession, sf: str) -> DataFrame:
    return dims.build_dim(sample.spu_info(spark, sf), "id", ["spu_name"])


def dim_user(spark: SparkSession, sf: str) -> DataFrame:
    return _users(spark, sf)


def dim_sku(spark: SparkSession, sf: str) -> DataFrame:
    return dims.build_sku_dim(
        sample.sku_info(spark, sf),
        sample.base_category3(spark, sf),
        sample.base_trademark(spark, sf),
        sample.spu_info(spark, sf),
    )


def dim_upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    order = ["changed_at", "change_id", "change_line", "source_id", "price_cents"]
    return latest_by_key(sample.sku_changes(spark, sf), ["id"], order).select(
        "id", "price_cents", "change_id", "change_line", "source_id"
    )


def order_first_flag(spark: SparkSession, sf: str) -> DataFrame:
    every = sample.order_info(spark, sf)
    batch = orders.derive_order_time(sample.order_batch(every))
    flagged = orders.flag_first_order(batch, sample.prior_user_state(every))
    return flagged.select("id", "user_id", "create_date", "create_hour", "if_first_order")


def user_state_upsert(spark: SparkSession, sf: str) -> DataFrame:
    every = sample.order_info(spark, sf)
    return orders.upsert_user_state(sample.order_batch(every), sample.prior_user_state(every))


def order_info_wide(spark: SparkSession, sf: str) -> DataFrame:
    return _orders(spark, sf).drop("expire_time", "operate_time")


def order_detail_wide(spark: SparkSession, sf: str) -> DataFrame:
    return _details(spark, sf).select(*[c for c in schemas.names(schemas.ORDER_DETAIL_WIDE) if c != "create_time"])


def unmatched_users(spark: SparkSession, sf: str) -> DataFrame:
    return dims.unmatched_count(sample.order_info(spark, sf), sample.user_info(spark, sf), "user_id", "id")


_PAIR = ["order_id", "order_detail_id", "user_id", "sku_id", "sku_num", "dt"]


def _arriving(spark: SparkSession, sf: str) -> DataFrame:
    """Order heads with their arrival and no looked-up attributes."""
    return sample.with_order_arrival(orders.derive_order_time(sample.order_info(spark, sf)))


def order_join_window(spark: SparkSession, sf: str) -> DataFrame:
    heads, hot = _arriving(spark, sf), _hot(spark, sf)
    lines = sample.with_detail_arrival(sample.order_detail(spark, sf, hot), 4)
    return wide.join_orders_window(heads, lines, hot).select(*_PAIR)


def order_join_cache(spark: SparkSession, sf: str) -> DataFrame:
    heads, hot = _arriving(spark, sf), _hot(spark, sf)
    lines = sample.with_detail_arrival(sample.order_detail(spark, sf, hot), 140)
    return wide.join_orders_cache(heads, lines, hot=hot).select(*_PAIR)


def order_wide(spark: SparkSession, sf: str) -> DataFrame:
    hot = _hot(spark, sf)
    fact = _wide(_orders(spark, sf), _details(spark, sf, hot), hot)
    return fact.select(*schemas.names(schemas.ORDER_WIDE))


def order_split(spark: SparkSession, sf: str) -> DataFrame:
    return _paid(spark, sf).select(
        "order_id", "order_detail_id", "final_total_amount", "original_total_amount", "final_detail_amount"
    )


def order_split_partial(spark: SparkSession, sf: str) -> DataFrame:
    return _partly_paid(spark, sf, _hot(spark, sf))


def order_split_sliced(spark: SparkSession, sf: str) -> DataFrame:
    """The same by the way that dominant orders take."""
    return _partly_paid(spark, sf, hot_keys(sample.order_detail_keys(spark, sf), "order_id", FEW_LINES))


def trademark_batch_stat(spark: SparkSession, sf: str) -> DataFrame:
    return _stat(spark, sf)


def trademark_topn(spark: SparkSession, sf: str) -> DataFrame:
    return trademark.trademark_topn(_stat(spark, sf))


def trademark_topn_range(spark: SparkSession, sf: str) -> DataFrame:
    return trademark.trademark_topn(_stat(spark, sf, SALES_FROM, SALES_TO), SALES_FROM, SALES_TO)


def datav_trademark(spark: SparkSession, sf: str) -> DataFrame:
    return trademark.to_datav(trademark.trademark_topn(_stat(spark, sf)))


def order_total(spark: SparkSession, sf: str) -> DataFrame:
    return reports.order_total(_paid(spark, sf))


def order_total_day(spark: SparkSession, sf: str) -> DataFrame:
    return reports.order_total(_paid(spark, sf, ORDER_DAY, ORDER_DAY), ORDER_DAY)


def order_hour_day(spark: SparkSession, sf: str) -> DataFrame:
    return reports.order_hour(_paid(spark, sf, ORDER_DAY, ORDER_DAY), ORDER_DAY)


def hour_compare_day(spark: SparkSession, sf: str) -> DataFrame:
    hourly = reports.order_hour(_paid(spark, sf, DAY_BEFORE, ORDER_DAY))
    return reports.hour_compare(hourly, "amount", ORDER_DAY)


def order_hour(spark: SparkSession, sf: str) -> DataFrame:
    return reports.order_hour(_paid(spark, sf))


def order_hour_compare(spark: SparkSession, sf: str) -> DataFrame:
    return reports.hour_compare(reports.order_hour(_paid(spark, sf)), "amount")


def realtime_total(spark: SparkSession, sf: str) -> DataFrame:
    return reports.realtime_total(dau_ops.dau_total(_dau(spark, sf)), reports.order_total(_paid(spark, sf)))


def _priced_skus(spark: SparkSession, sf: str) -> DataFrame:
    return sample.sku_dim(spark, sf).withColumns({"id": F.col("id").cast("bigint"), "price": F.col("price").cast(schemas.MONEY)})


def search_page(spark: SparkSession, sf: str) -> DataFrame:
    return reports.search_page(_priced_skus(spark, sf), "sku_name", SEARCH_WORD, ["price", "id"], SEARCH_FROM, SEARCH_SIZE)


def sale_detail(spark: SparkSession, sf: str) -> DataFrame:
    return reports.sale_detail(
        _sales(spark, sf),
        sample.user_info(spark, sf),
        sample.as_of(),
        keyword=SEARCH_WORD,
        page=2,
        size=SEARCH_SIZE,
    )


def sale_detail_total(spark: SparkSession, sf: str) -> DataFrame:
    return reports.sale_detail_total(_sales(spark, sf), keyword=SEARCH_WORD)


def sale_detail_stats(spark: SparkSession, sf: str) -> DataFrame:
    return reports.sale_detail_stats(_sales(spark, sf), keyword=SEARCH_WORD)


def province_sales(spark: SparkSession, sf: str) -> DataFrame:
    heads = orders.join_province(sample.order_info(spark, sf), sample.base_province(spark, sf))
    hot = _hot(spark, sf)
    return reports.province_sales(_wide(heads, sample.order_detail(spark, sf, hot), hot))


# --- the same from stored tables that batches have filled ---------------------


def dim_upsert_stored(spark: SparkSession, sf: str) -> DataFrame:
    order = ["changed_at", "change_id", "change_line", "source_id", "price_cents"]
    turn = F.pmod(F.xxhash64("change_id", "change_line"), F.lit(3))
    found = batches.upserted(sample.sku_changes(spark, sf), batches.PRICE_CHANGES, "id", order, turn)
    return found.select("id", "price_cents", "change_id", "change_line", "source_id")


def user_state_stored(spark: SparkSession, sf: str) -> DataFrame:
    every = sample.order_info(spark, sf)
    return batches.user_state(sample.order_batch(every), sample.prior_user_state(every), orders.new_user_state)


def _turn_of_line() -> Column:
    """Lines come two at a time, the rest last."""
    number = F.floor(F.col("order_detail_id") / F.lit(10**17))
    return F.when(number <= 2, 0).when(number <= 4, 1).otherwise(2)


def _lines_arriving(spark: SparkSession, sf: str, hot: HotKeys) -> DataFrame:
    return sample.with_line_arrival(_details(spark, sf, hot), 4)


def order_split_stored(spark: SparkSession, sf: str) -> DataFrame:
    """``order_split_partial`` with the lines of an order spread over batches."""
    hot = _hot(spark, sf)
    lines = _lines_arriving(spark, sf, hot)
    heads = _partly_stated(spark, sf, lines)
    pairs = wide.join_order_detail(heads, lines, hot, detail_extra=("arrival",))
    fact = wide.to_order_wide(pairs.withColumn("arrival", F.col("arrival").cast("timestamp")), ("arrival",)).drop("_slice", "_slices")
    return batches.allocated(fact, _turn_of_line(), hot).select(*_SPLIT)


def brand_amount_sliding(spark: SparkSession, sf: str) -> DataFrame:
    """Allocated amount by brand in windows of 15 s that start every 5 s, at the arrival of the lines."""
    hot = _hot(spark, sf)
    heads = orders.derive_order_time(sample.order_info(spark, sf))
    pairs = wide.join_order_detail(heads, _lines_arriving(spark, sf, hot), hot, detail_extra=("arrival",))
    paid = wide.allocate_amount(wide.to_order_wide(pairs, ("arrival",)), hot)
    at = epoch_seconds(F.col("arrival"))
    return trademark.sliding_amount(paid, at, wide.WINDOW_SECONDS, wide.SLIDE_SECONDS)


def _order_rollup(spark: SparkSession, sf: str) -> PartTable:
    hot = _hot(spark, sf)
    return batches.order_rollup(_allocated(spark, sf, _details(spark, sf, hot), hot))


def order_total_stored(spark: SparkSession, sf: str) -> DataFrame:
    return stored.order_total(_order_rollup(spark, sf), spark, ORDER_DAY)


def order_hour_stored(spark: SparkSession, sf: str) -> DataFrame:
    return stored.order_hour(_order_rollup(spark, sf), spark, ORDER_DAY)


def hour_compare_stored(spark: SparkSession, sf: str) -> DataFrame:
    hourly = stored.order_hour(_order_rollup(spark, sf), spark, DAY_BEFORE, ORDER_DAY)
    return reports.hour_compare(hourly, "amount", ORDER_DAY)


def trademark_range_stored(spark: SparkSession, sf: str) -> DataFrame:
    return stored.trademark_topn(_order_rollup(spark, sf), spark, SALES_FROM, SALES_TO)


def search_index(spark: SparkSession, sf: str) -> DataFrame:
    """``search_page`` by an inverted index over the names, and the rows of the page from their buckets."""
    skus = _priced_skus(spark, sf)
    table, index = batches.new_table(skus, "id"), batches.new_folder(spark)
    search.write_index(skus, "sku_name", "id", ["price", "id"], index)
    return search.search_page(spark, index, table, SEARCH_WORD, ["price", "id"], SEARCH_FROM, SEARCH_SIZE)


def sale_detail_keyset(spark: SparkSession, sf: str) -> DataFrame:
    """``sale_detail`` from matching lines stored in page order; the page starts behind the last key of the one before."""
    sort = ["dt", "order_id", "order_detail_id"]
    folder = batches.new_folder(spark)
    pages.write_sorted(reports.sale_lines(_sales(spark, sf), keyword=SEARCH_WORD), folder, sort, PAGE_FILE_ROWS)
    before = pages.page(spark, folder, sort, 1, SEARCH_SIZE).orderBy(*[F.desc(c) for c in sort]).first()
    last = None if before is None else [before[c] for c in sort]
    rows = pages.page_after(spark, folder, sort, last, SEARCH_SIZE)
    return reports.sale_rows(rows, sample.user_info(spark, sf), sample.as_of())


def dau_total_stored(spark: SparkSession, sf: str) -> DataFrame:
    starts = routing.route_app_log(sample.app_logs(spark, sf)).where(F.col("topic") == routing.START_TOPIC)
    table = batches.device_rollup(dau_ops.to_dau_info(decode(starts, schemas.START_LOG)))
    return stored.dau_total(table, spark, LOG_DAY)


_QUERIES = [
    app_log_route,
    raw_log_archive_counts,
    dau_detail,
    dau_total,
    dau_total_day,
    dau_hour,
    dau_hour_compare,
    cdc_object_route,
    cdc_array_route,
    dim_province,
    dim_category3,
    dim_trademark,
    dim_spu,
    dim_user,
    dim_sku,
    dim_upsert_latest,
    order_first_flag,
    user_state_upsert,
    order_info_wide,
    order_detail_wide,
    unmatched_users,
    order_join_window,
    order_join_cache,
    order_wide,
    order_split,
    order_split_partial,
    order_split_sliced,
    trademark_batch_stat,
    trademark_topn,
    trademark_topn_range,
    datav_trademark,
    order_total,
    order_total_day,
    order_hour,
    order_hour_day,
    order_hour_compare,
    hour_compare_day,
    realtime_total,
    search_page,
    sale_detail,
    sale_detail_total,
    sale_detail_stats,
    province_sales,
    dim_upsert_stored,
    user_state_stored,
    order_split_stored,
    brand_amount_sliding,
    order_total_stored,
    order_hour_stored,
    hour_compare_stored,
    trademark_range_stored,
    dau_total_stored,
    search_index,
    sale_detail_keyset,
]


def _registered(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _doubles(build(spark, sf_dir))

    run.__name__ = build.__name__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {build.__name__: _registered(build) for build in _QUERIES}
