"""Display labels and the rules that pick them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and thresholds that stored data and dashboards depend on.
AGE_UP_TO_20 = "20岁及以下"
AGE_21_TO_30 = "21岁到30岁"
AGE_OVER_30 = "30岁以上"
MALE = "男"
FEMALE = "女"
DAU_PANEL_NAME = "新增日活"
ORDER_PANEL_NAME = "新增交易额"
DAYS_PER_YEAR = 365


def age_on(birthday: Column, as_of: Column) -> Column:
    """Whole years of 365 days between birthday and ``as_of``."""
    return F.floor(F.datediff(as_of.cast("date"), birthday.cast("date")) / DAYS_PER_YEAR).cast("int")


def age_group(age: Column) -> Column:
    return (
        F.when(age < 20, F.lit(AGE_UP_TO_20))
        .when(age > 30, F.lit(AGE_OVER_30))
        .when(age.isNotNull(), F.lit(AGE_21_TO_30))
    )


def gender_name(gender: Column) -> Column:
    """``M`` is male; everything else, missing included, counts as female."""
    return F.when(gender == "M", F.lit(MALE)).otherwise(F.lit(FEMALE))
