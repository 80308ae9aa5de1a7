"""The order fact: order and line joined, and the paid amount allocated to lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater import schemas
from tidewater.functions.clock import epoch_seconds
from tidewater.functions.money import cents, money, proportional_cents
from tidewater.operators.skew import SLICE, SLICES, HotKeys, deal, deal_ranges, hot_keys, ranges, repeat

# Join window, slide and state lifetime in seconds.
WINDOW_SECONDS = 15
SLIDE_SECONDS = 5
STATE_TTL_SECONDS = 600

# Column of the order row -> column of the fact.
ORDER_COLUMNS = {
    "id": "order_id",
    "order_status": "order_status",
    "create_time": "create_time",
    "user_id": "user_id",
    "benefit_reduce_amount": "benefit_reduce_amount",
    "feight_fee": "feight_fee",
    "original_total_amount": "original_total_amount",
    "final_total_amount": "final_total_amount",
    "if_first_order": "if_first_order",
    "province_name": "province_name",
    "province_area_code": "province_area_code",
    "user_age_group": "user_age_group",
    "user_gender": "user_gender",
    "create_date": "dt",
}
# Column of the line row -> column of the fact.
DETAIL_COLUMNS = {
    "id": "order_detail_id",
    "sku_id": "sku_id",
    "order_price": "sku_price",
    "sku_num": "sku_num",
    "sku_name": "sku_name",
    "spu_id": "spu_id",
    "tm_id": "tm_id",
    "category3_id": "category3_id",
    "spu_name": "spu_name",
    "tm_name": "tm_name",
    "category3_name": "category3_name",
}


def _renamed(df: DataFrame, columns: dict[str, str], extra: tuple[str, ...]) -> DataFrame:
    return df.select(*[F.col(a).alias(b) for a, b in columns.items() if a in df.columns], *extra)


def join_order_detail(
    orders: DataFrame,
    details: DataFrame,
    hot: HotKeys | None = None,
    order_extra: tuple[str, ...] = (),
    detail_extra: tuple[str, ...] = (),
    copies: bool = False,
) -> DataFrame:
    """Inner join of orders and lines on the order id, columns named as in the fact.

    Sides may leave out attributes nobody asks for; the fact then lacks them.
    Lines of an order that dominates the table are dealt into slices by ranges of
    line ids, whose columns stay on the result for :func:`allocate_amount`. With
    ``copies``, where a line may come very often, they are dealt by a hash of all
    that tells copies apart, for :func:`dedup_join`. Give ``hot`` when the lines'
    order ids can be had from a cheaper scan.
    """
    lines = _renamed(details, {"order_id": "order_id", **DETAIL_COLUMNS}, detail_extra)
    heads = _renamed(orders, ORDER_COLUMNS, order_extra)
    hot = hot_keys(lines, "order_id") if hot is None else hot
    if not hot:
        return heads.join(lines, "order_id")
    if copies:
        dealt = deal(lines, hot, ["order_detail_id", *detail_extra])
    else:
        hot = ranges(lines, hot, "order_detail_id")
        dealt = deal_ranges(lines, hot, "order_detail_id")
    return repeat(heads, hot).join(dealt, ["order_id", SLICE, SLICES])


def to_order_wide(joined: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns of the fact that are at hand, missing numbers as 0 and no amount allocated yet."""
    have = joined.withColumn("final_detail_amount", F.lit(0))
    columns = []
    for field in StructType.fromDDL(schemas.ORDER_WIDE).fields:
        if field.name in have.columns:
            column = F.col(field.name)
            # The ids come from the join and keep its partitioning only as they are.
            if field.dataType.typeName() != "string" and field.name not in ("order_id", "order_detail_id"):
                column = F.coalesce(column, F.lit(0)).cast(field.dataType).alias(field.name)
            columns.append(column)
    return have.select(*columns, *keep, *[c for c in (SLICE, SLICES) if c in joined.columns])


def _line_shares(wide: DataFrame) -> DataFrame:
    """Add the line's amount, its proportional share in cents, and 1."""
    paid, original = cents(F.col("final_total_amount")), cents(F.col("original_total_amount"))
    rows = wide.withColumn("_amount", cents(F.col("sku_price")) * F.col("sku_num"))
    return rows.withColumn("_share", proportional_cents(paid, F.col("_amount"), original)).withColumn("_line", F.lit(1))


def order_sums(wide: DataFrame, *more: Column) -> DataFrame:
    """What :func:`allocate_amount` has to know of the lines before: per order, sums of amounts, shares and lines."""
    totals = [F.sum(c).cast("bigint").alias(f"{c[1:]}s") for c in _RUNNING]
    return _line_shares(wide).groupBy("order_id").agg(*totals, *more)


def allocate_amount(wide: DataFrame, hot: HotKeys | None = None, carried: DataFrame | None = None) -> DataFrame:
    """Fill ``final_detail_amount``: the order's paid amount split over its lines.

    A line gets paid total x price x number / original total, rounded to cents.
    The line at which the amounts, summed in the order of line ids, reach the
    original total gets what the lines before it leave. Orders whose running
    amount never meets the total have no such line.

    The sums run as a window over the partitioning of the join. Lines of an
    order that dominates lie in slices that are ranges of line ids, as
    :func:`join_order_detail` deals them, or are dealt so here, and each range
    starts from the totals of those before it. ``carried`` holds the
    :func:`order_sums` of lines allocated earlier, on which all these go on.
    """
    if hot is None and SLICE not in wide.columns:
        hot = hot_keys(wide, "order_id")
    if hot and SLICE not in wide.columns:
        wide = deal_ranges(wide, ranges(wide, hot, "order_detail_id"), "order_detail_id")
    out = [c for c in wide.columns if c not in (SLICE, SLICES)]
    paid, original = cents(F.col("final_total_amount")), cents(F.col("original_total_amount"))
    rows = _line_shares(wide)
    summed = _running_by_range(rows) if SLICE in wide.columns else _running(rows, ["order_id"])
    if carried is not None:
        earlier = carried.select("order_id", *[F.col(f"{c[1:]}s").alias(f"{c}_earlier") for c in _RUNNING])
        summed = summed.join(earlier, "order_id", "left")
        summed = summed.withColumns({f"{c}_so_far": F.col(f"{c}_so_far") + F.coalesce(f"{c}_earlier", F.lit(0)) for c in _RUNNING})
    # Lines without an amount complete nothing, except the first of an order without a total.
    completes = (F.col("_amount_so_far") == original) & ((F.col("_amount") > 0) | (F.col("_line_so_far") == 1))
    share = F.when(completes, paid - F.col("_share_so_far") + F.col("_share")).otherwise(F.col("_share"))
    return summed.withColumn("final_detail_amount", money(share)).select(*out)


_RUNNING = ("_amount", "_share", "_line")


def _running(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Running sums of amount, share and lines in the order of line ids."""
    so_far = Window.partitionBy(*keys).orderBy("order_detail_id").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumns({f"{c}_so_far": F.sum(c).over(so_far) for c in _RUNNING})


def _running_by_range(rows: DataFrame) -> DataFrame:
    """The same over slices that are ranges of line ids: within ranges, then on top of the ranges before.

    Other orders are one range, on top of nothing; only the totals of dominant ones are taken.
    """
    key = ["order_id", SLICE, SLICES]
    totals = rows.where(F.col(SLICES) > 1).groupBy(*key).agg(*[F.sum(c).alias(f"{c}_total") for c in _RUNNING])
    before = Window.partitionBy("order_id").orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    earlier = totals.select(*key, *[F.sum(f"{c}_total").over(before).alias(f"{c}_before") for c in _RUNNING])
    summed = _running(rows, key).join(earlier.where("_line_before > 0"), key, "left")
    whole = {f"{c}_so_far": F.col(f"{c}_so_far") + F.coalesce(f"{c}_before", F.lit(0)) for c in _RUNNING}
    return summed.withColumns(whole).drop(SLICE, SLICES, *[f"{c}_before" for c in _RUNNING])


def dedup_join(joined: DataFrame, arrival: str) -> DataFrame:
    """One row per order and line, the earliest arrived; redelivered lines collapse.

    Of equal arrivals the least in the remaining columns stays. Copies are ranked within the join's partitioning. Where some order was dealt
    into slices, copies of a line sit in several of them, so a minimum is taken
    instead; it combines before the shuffle, whatever the number of copies.
    """
    keys = ["order_id", "order_detail_id"]
    if SLICE not in joined.columns:
        rest = [c for c in joined.columns if c not in keys and c != arrival]
        copy = F.row_number().over(Window.partitionBy(*keys).orderBy(arrival, *rest))
        return joined.withColumn("_copy", copy).where(F.col("_copy") == 1).drop("_copy")
    out = [c for c in joined.columns if c not in (SLICE, SLICES)]
    first = F.min(F.struct(arrival, *[c for c in out if c not in keys and c != arrival])).alias("_first")
    return joined.groupBy(*keys).agg(first).select(
        *[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in out]
    )


def _batch_number(arrival: str):
    return F.floor(epoch_seconds(F.col(arrival)) / SLIDE_SECONDS)


def join_orders_window(orders: DataFrame, details: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Pairs whose arrivals fall into one sliding window, each line once.

    Both sides carry ``arrival``. With windows of three slides a pair meets
    exactly when its arrival batches are at most two apart.
    """
    reach = WINDOW_SECONDS // SLIDE_SECONDS - 1
    heads = orders.withColumn("_order_batch", _batch_number("arrival"))
    lines = details.withColumn("_detail_batch", _batch_number("arrival")).withColumnRenamed("arrival", "_arrival")
    joined = join_order_detail(heads, lines, hot, ("_order_batch",), ("_detail_batch", "_arrival"), copies=True)
    met = joined.where(F.abs(F.col("_order_batch") - F.col("_detail_batch")) <= reach)
    return to_order_wide(dedup_join(met, "_arrival"))


def join_orders_cache(
    orders: DataFrame, details: DataFrame, ttl_seconds: int = STATE_TTL_SECONDS, hot: HotKeys | None = None
) -> DataFrame:
    """Pairs that arrive less than ``ttl_seconds`` apart, whichever side is first, each line once."""
    heads = orders.withColumn("_order_at", epoch_seconds(F.col("arrival")))
    lines = details.withColumn("_detail_at", epoch_seconds(F.col("arrival")))
    joined = join_order_detail(heads, lines, hot, ("_order_at",), ("_detail_at",), copies=True)
    met = joined.where(F.abs(F.col("_order_at") - F.col("_detail_at")) < ttl_seconds)
    return to_order_wide(dedup_join(met, "_detail_at"))
