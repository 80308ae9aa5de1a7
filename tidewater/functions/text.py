"""Keyword matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def terms(text: Column) -> Column:
    """Lower-case words of a text."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: F.length(w) > 0)


def match_terms(df: DataFrame, column: str, keyword: str | None) -> DataFrame:
    """Rows whose ``column`` holds at least one word of ``keyword``.

    A missing or blank keyword keeps every row.
    """
    if not keyword or not keyword.strip():
        return df
    return df.where(F.arrays_overlap(terms(F.col(column)), terms(F.lit(keyword))))
