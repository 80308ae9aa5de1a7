"""What the dashboards ask: totals, hourly comparison, search, detail pages, maps.

Reports that take a ``date`` answer for that day and, without one, for every day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.clock import parse_time, two_digits
from tidewater.functions.labels import DAU_PANEL_NAME, ORDER_PANEL_NAME, age_on
from tidewater.functions.money import round_half_up
from tidewater.functions.text import match_terms


def _on(df: DataFrame, date: str | None) -> DataFrame:
    return df if date is None else df.where(F.col("dt") == date)


def order_total(wide: DataFrame, date: str | None = None) -> DataFrame:
    """Allocated amount per day; a single day without orders gives 0."""
    days = _on(wide, date)
    if date is None:
        return days.groupBy("dt").agg(F.sum("final_detail_amount").alias("amount"))
    total = F.coalesce(F.sum("final_detail_amount"), F.lit(0))
    return days.agg(total.alias("amount")).select(F.lit(date).alias("dt"), "amount")


def order_hour(wide: DataFrame, date: str | None = None) -> DataFrame:
    """Allocated amount per day and two-digit hour."""
    hour = two_digits(F.hour(parse_time(F.col("create_time"))))
    return _on(wide, date).groupBy("dt", hour.alias("hr")).agg(F.sum("final_detail_amount").alias("amount"))


def hour_compare(hourly: DataFrame, value: str, date: str | None = None) -> DataFrame:
    """24 rows per day with the value of that day and of the day before, 0 where there is none.

    ``hourly`` has ``dt, hr`` and the value, at most 24 rows per day. Every row
    counts for its own day and the next, so ``hourly`` is computed once.
    """
    own, following = F.col("dt"), F.date_add(F.col("dt").cast("date"), 1).cast("string")
    none = F.lit(None)
    sides = F.array(
        F.struct(own.alias("day"), F.col(value).alias("today"), none.alias("yesterday"), F.lit(True).alias("own")),
        F.struct(following.alias("day"), none.alias("today"), F.col(value).alias("yesterday"), F.lit(False).alias("own")),
    )
    if date is not None:
        hourly = hourly.where((own == date) | (following == date))
    both = hourly.select("hr", F.inline(sides))
    if date is not None:
        both = both.where(F.col("day") == date)
    hours = both.groupBy("day", "hr").agg(
        F.sum("today").alias("today"), F.sum("yesterday").alias("yesterday"), F.max("own").alias("own")
    )
    # At most 24 entries per day.
    entries = F.map_from_entries(F.collect_list(F.struct("hr", F.struct("today", "yesterday")))).alias("_by_hour")
    if date is None:
        days = hours.groupBy("day").agg(entries, F.max("own").alias("_own")).where("_own")
    else:
        days = hours.agg(entries).withColumn("day", F.lit(date))

    def row(h: Column) -> Column:
        hour = two_digits(h)
        found = F.try_element_at("_by_hour", hour)
        return F.struct(
            hour.alias("hr"),
            F.coalesce(found["today"], F.lit(0)).alias("today"),
            F.coalesce(found["yesterday"], F.lit(0)).alias("yesterday"),
        )

    panel = F.transform(F.sequence(F.lit(0), F.lit(23)), row)
    return days.select(F.col("day").alias("dt"), F.inline(panel))


def realtime_total(dau_totals: DataFrame, order_totals: DataFrame, date: str | None = None) -> DataFrame:
    """Panel rows ``dt, id, name, value``: active devices and order amount, 0 where there is none."""
    dau = dau_totals.select("dt", F.col("total").alias("_dau"), F.lit(None).alias("_amount"))
    orders = order_totals.select("dt", F.lit(None).alias("_dau"), F.col("amount").alias("_amount"))
    both = _on(dau.unionByName(orders), date)
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("decimal(28,2)").alias(c) for c in ("_dau", "_amount")]
    if date is None:
        days = both.groupBy("dt").agg(*sums)
    else:
        days = both.agg(*sums).withColumn("dt", F.lit(date))
    panels = F.array(
        F.struct(F.lit("dau").alias("id"), F.lit(DAU_PANEL_NAME).alias("name"), F.col("_dau").alias("value")),
        F.struct(
            F.lit("order_amount").alias("id"), F.lit(ORDER_PANEL_NAME).alias("name"), F.col("_amount").alias("value")
        ),
    )
    return days.select("dt", F.explode(panels).alias("_p")).select("dt", "_p.*")


def search_page(
    df: DataFrame, column: str, keyword: str | None, sort: list[str], start: int = 0, size: int = 20
) -> DataFrame:
    """One page of the rows that match ``keyword``, in ascending ``sort`` order."""
    return match_terms(df, column, keyword).orderBy(*sort).offset(start).limit(size)


def _sales(wide: DataFrame, date: str | None, keyword: str | None) -> DataFrame:
    return match_terms(_on(wide, date), "sku_name", keyword)


def sale_detail(
    wide: DataFrame,
    users: DataFrame,
    as_of: Column,
    date: str | None = None,
    keyword: str | None = None,
    page: int = 1,
    size: int = 20,
) -> DataFrame:
    """One page of sale lines in 11 columns; pages count from 1.

    User attributes are looked up for the page's rows only.
    """
    lines = sale_lines(wide, date, keyword).orderBy("dt", "order_id", "order_detail_id")
    return sale_rows(lines.offset((page - 1) * size).limit(size), users, as_of)


def sale_lines(wide: DataFrame, date: str | None = None, keyword: str | None = None) -> DataFrame:
    """What the detail page shows of the matching lines themselves."""
    columns = ["order_detail_id", "order_id", "user_id", "sku_id", "user_gender", "sku_price", "sku_name", "tm_id", "dt"]
    return _sales(wide, date, keyword).select(*columns)


def sale_rows(rows: DataFrame, users: DataFrame, as_of: Column) -> DataFrame:
    """The rows of a page with the attributes of their users."""
    who = users.select(
        F.col("id").cast("bigint").alias("user_id"), age_on(F.col("birthday"), as_of).alias("user_age"), "user_level"
    )
    return rows.join(who, "user_id", "left").select(
        "order_detail_id",
        "order_id",
        "user_id",
        "sku_id",
        "user_gender",
        "user_age",
        "user_level",
        "sku_price",
        "sku_name",
        F.col("tm_id").cast("string").alias("sku_tm_id"),
        "dt",
    ).orderBy("dt", "order_id", "order_detail_id")  # the join need not keep the page's order


def sale_detail_total(wide: DataFrame, date: str | None = None, keyword: str | None = None) -> DataFrame:
    """Number of sale lines over all pages."""
    return _sales(wide, date, keyword).agg(F.count("*").alias("total"))


def sale_detail_stats(wide: DataFrame, date: str | None = None, keyword: str | None = None) -> DataFrame:
    """Sale lines by age band and by gender, with the share of each in percent.

    Both breakdowns come from one grouping; only its few rows are repeated.
    """
    cells = (
        _sales(wide, date, keyword).groupBy("user_age_group", "user_gender").agg(F.count("*").alias("_n"))
    )
    options = F.array(
        F.struct(F.lit("age").alias("stat"), F.col("user_age_group").alias("name")),
        F.struct(F.lit("gender").alias("stat"), F.col("user_gender").alias("name")),
    )
    groups = (
        cells.select(F.explode(options).alias("_o"), "_n")
        .groupBy("_o.stat", "_o.name")
        .agg(F.sum("_n").alias("value"))
    )
    totals = groups.groupBy("stat").agg(F.sum("value").alias("_all"))
    share = round_half_up(F.col("value") * 100 / F.col("_all"), 1)
    return groups.join(totals, "stat").select("stat", "name", "value", share.alias("share"))


def province_sales(wide: DataFrame, date: str | None = None) -> DataFrame:
    """Pieces sold per province."""
    return _on(wide, date).groupBy("province_name").agg(F.sum("sku_num").alias("sku_num"))
