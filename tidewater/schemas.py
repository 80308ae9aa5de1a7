"""Column types of every record the warehouse exchanges (never inferred)."""

from __future__ import annotations

MONEY = "decimal(18,2)"

# Field names and types of the records that producers and consumers exchange.

START_LOG = "common struct<mid:string,uid:string,ar:string,ch:string,vc:string>, ts bigint"

BASE_PROVINCE = "id string, name string, area_code string, iso_code string, iso_3166_2 string"
BASE_CATEGORY3 = "id string, name string, category2_id string"
# The key may arrive as tm_id or as id.
BASE_TRADEMARK = "tm_id string, id string, tm_name string"
SPU_INFO = "id string, spu_name string"
SKU_INFO = (
    "id string, spu_id string, price string, sku_name string, tm_id string, "
    "category3_id string, create_time string"
)
SKU_DIM = SKU_INFO + ", category3_name string, spu_name string, tm_name string"
USER_INFO = "id string, user_level string, birthday string, gender string"
USER_DIM = USER_INFO + ", age_group string, gender_name string"
USER_STATE = "user_id string, if_consumed string, first_order_id bigint"

ORDER_INFO = (
    f"id bigint, province_id bigint, order_status string, user_id bigint, "
    f"final_total_amount {MONEY}, benefit_reduce_amount {MONEY}, original_total_amount {MONEY}, "
    f"feight_fee {MONEY}, expire_time string, create_time string, operate_time string"
)
ORDER_INFO_WIDE = ORDER_INFO + (
    ", create_date string, create_hour string, if_first_order string, province_name string, "
    "province_area_code string, province_3166_2_code string, user_age_group string, user_gender string"
)
ORDER_DETAIL = (
    f"id bigint, order_id bigint, sku_id bigint, order_price {MONEY}, sku_num bigint, "
    f"sku_name string, create_time string"
)
ORDER_DETAIL_WIDE = ORDER_DETAIL + (
    ", spu_id bigint, tm_id bigint, category3_id bigint, spu_name string, tm_name string, "
    "category3_name string"
)
ORDER_WIDE = (
    f"order_detail_id bigint, order_id bigint, order_status string, create_time string, "
    f"user_id bigint, sku_id bigint, sku_price {MONEY}, sku_num bigint, sku_name string, "
    f"benefit_reduce_amount {MONEY}, feight_fee {MONEY}, original_total_amount {MONEY}, "
    f"final_total_amount {MONEY}, final_detail_amount {MONEY}, if_first_order string, "
    f"province_name string, province_area_code string, user_age_group string, user_gender string, "
    f"dt string, spu_id bigint, tm_id bigint, category3_id bigint, spu_name string, "
    f"tm_name string, category3_name string"
)
DAU_INFO = (
    "mid string, uid string, ar string, ch string, vc string, dt string, hr string, mi string, "
    "ts bigint"
)
TRADEMARK_STAT = f"stat_date string, stat_time string, tm_id string, tm_name string, amount {MONEY}"

TOPIC_ROW = "key string, value string, timestamp timestamp, topic string"
# Names a record through repeated batches; records of other writers have none.
RECORD_ID = "record_id"


def names(ddl: str) -> list[str]:
    """Column names of a flat schema above."""
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl).names
