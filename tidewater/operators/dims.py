"""Dimension tables and lookups against them.

Lookups carry no broadcast hint: Spark broadcasts a dimension while its measured
size is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it beyond
that, splitting oversized partitions of the fact side (adaptive skew join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.labels import age_group, age_on, gender_name
from tidewater.sinks.tables import latest_by_key


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    columns: dict[str, Column],
    strict: bool = False,
) -> DataFrame:
    """Left join that adds ``columns`` of the matching dimension row, null when there is none.

    ``strict`` makes the query fail on a row without a match.
    """
    key_type = facts.schema[fact_key].dataType
    side = dim.select(F.col(dim_key).cast(key_type).alias("_dim_key"), *[c.alias(n) for n, c in columns.items()])
    joined = facts.join(side, F.col(fact_key) == F.col("_dim_key"), "left")
    if strict:
        message = F.concat(F.lit(f"no row for {fact_key} "), F.coalesce(F.col(fact_key).cast("string"), F.lit("null")))
        checked = F.when(F.col("_dim_key").isNull(), F.raise_error(message)).otherwise(F.col(fact_key))
        joined = joined.withColumn(fact_key, checked)
    return joined.drop("_dim_key")


def unmatched_count(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """One row with the number of fact rows that have no dimension row."""
    key_type = facts.schema[fact_key].dataType
    keys = dim.select(F.col(dim_key).cast(key_type).alias(fact_key))
    return facts.select(fact_key).join(keys, fact_key, "left_anti").agg(F.count("*").alias("unmatched"))


def build_dim(rows: DataFrame, key: str, order_by: list[str], operation: str | None = None) -> DataFrame:
    """Latest row per key of a pass-through dimension.

    Deletes count as upserts unless ``operation`` names the column that marks them.
    """
    latest = latest_by_key(rows, [key], order_by)
    return latest if operation is None else latest.where(F.lower(operation) != "delete")


def trademark_key(rows: DataFrame) -> DataFrame:
    """Brands arrive keyed by ``tm_id`` or by ``id``."""
    return rows.select(F.coalesce("tm_id", "id").alias("tm_id"), "tm_name")


def derive_user(users: DataFrame, as_of: Column) -> DataFrame:
    """Add ``age_group`` and ``gender_name``."""
    age = age_on(F.col("birthday"), as_of)
    return users.withColumns({"age_group": age_group(age), "gender_name": gender_name(F.col("gender"))})


def build_sku_dim(sku: DataFrame, category3: DataFrame, trademark: DataFrame, spu: DataFrame) -> DataFrame:
    """SKU rows with the names of their category, brand and product."""
    named = lookup(sku, category3, "category3_id", "id", {"category3_name": F.col("name")})
    named = lookup(named, trademark, "tm_id", "tm_id", {"tm_name": F.col("tm_name")})
    named = lookup(named, spu, "spu_id", "id", {"spu_name": F.col("spu_name")})
    return named.select(*sku.columns, "category3_name", "spu_name", "tm_name")
