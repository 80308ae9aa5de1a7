"""Order and order-line facts: calendar fields, first-order flag, dimension lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater import schemas
from tidewater.operators.dims import lookup
from tidewater.sinks.tables import latest_by_key


def derive_order_time(orders: DataFrame) -> DataFrame:
    """Add ``create_date`` and ``create_hour`` from the text ``create_time``."""
    parts = F.split("create_time", " ")
    clock = F.split(F.get(parts, 1), ":")
    return orders.withColumns({"create_date": F.get(parts, 0), "create_hour": F.get(clock, 0)})


def first_orders(orders: DataFrame, state: DataFrame) -> DataFrame:
    """``user_id, first_order_id`` of users in ``orders`` who had not bought before.

    The earliest order is a minimum, combined before the shuffle, so a user with
    very many orders never gathers in one task. Equal times go to the smaller id.
    """
    earliest = orders.groupBy("user_id").agg(F.min(F.struct("create_time", "id")).alias("_first"))
    known = state.where(F.col("if_consumed") == "1").select(F.col("user_id").cast("bigint").alias("user_id"))
    return earliest.join(known, "user_id", "left_anti").select("user_id", F.col("_first.id").alias("first_order_id"))


def flag_first_order(orders: DataFrame, state: DataFrame) -> DataFrame:
    """Add ``if_first_order``: ``1`` on a user's earliest order when ``state`` does not know the user.

    The order that ``state`` names as a user's first has it again when it is delivered again.
    The flag comes back over the order id, which is unique, not over the user.
    """
    stored = state.where(F.col("if_consumed") == "1").select(F.col("first_order_id").alias("_first_id"))
    first = first_orders(orders, state).select(F.col("first_order_id").alias("_first_id"))
    first = first.unionAll(stored.where("_first_id is not null")).distinct()
    flag = F.when(F.col("_first_id").isNotNull(), "1").otherwise("0")
    return (
        orders.join(first, F.col("id") == F.col("_first_id"), "left")
        .withColumn("if_first_order", flag)
        .drop("_first_id")
    )


def new_user_state(orders: DataFrame, state: DataFrame) -> DataFrame:
    """State rows to add for the users whose first order is in ``orders``."""
    return first_orders(orders, state).select(
        F.col("user_id").cast("string").alias("user_id"), F.lit("1").alias("if_consumed"), "first_order_id"
    )


def upsert_user_state(orders: DataFrame, state: DataFrame) -> DataFrame:
    """State after ``orders``: known users keep their row, new buyers get one."""
    after = state.withColumn("_v", F.lit(1)).unionByName(new_user_state(orders, state).withColumn("_v", F.lit(0)))
    # A known user that had not bought is replaced by the new row.
    bought = F.when(F.col("if_consumed") == "1", 1).otherwise(0)
    return latest_by_key(after, ["user_id"], [bought, F.col("_v")]).drop("_v")


def join_province(orders: DataFrame, provinces: DataFrame) -> DataFrame:
    return lookup(
        orders,
        provinces,
        "province_id",
        "id",
        {
            "province_name": F.col("name"),
            "province_area_code": F.col("area_code"),
            "province_3166_2_code": F.col("iso_3166_2"),
        },
    )


def join_user(orders: DataFrame, users: DataFrame, strict: bool = False) -> DataFrame:
    columns = {"user_age_group": F.col("age_group"), "user_gender": F.col("gender_name")}
    return lookup(orders, users, "user_id", "id", columns, strict)


def join_sku(details: DataFrame, skus: DataFrame, strict: bool = False) -> DataFrame:
    """Order lines with the six attributes of their SKU."""
    columns = {n: F.col(n).cast("bigint") for n in ("spu_id", "tm_id", "category3_id")}
    columns |= {n: F.col(n) for n in ("spu_name", "tm_name", "category3_name")}
    return lookup(details, skus, "sku_id", "id", columns, strict)


def order_info_wide(
    orders: DataFrame,
    state: DataFrame,
    provinces: DataFrame,
    users: DataFrame,
    strict: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Orders with calendar fields, first-order flag, province and user attributes."""
    flagged = flag_first_order(derive_order_time(orders), state)
    wide = join_user(join_province(flagged, provinces), users, strict)
    return wide.select(*schemas.names(schemas.ORDER_INFO_WIDE), *keep)
