"""Exact money arithmetic in whole cents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Below this bound twice the product of two amounts still fits a bigint.
_SMALL = 1 << 30


def cents(amount: Column) -> Column:
    """Money to whole cents."""
    return (amount.cast("decimal(18,2)") * 100).cast("bigint")


def money(cents_col: Column) -> Column:
    """Whole cents to money."""
    return (cents_col.cast("decimal(20,0)") / 100).cast("decimal(18,2)")


def round_half_up(x: Column, digits: int = 2) -> Column:
    """Rounding with ties toward plus infinity, also for negative numbers."""
    scale = 10**digits
    return F.floor(x * scale + F.lit(0.5)) / scale


def _rounded_quotient(total: Column, part: Column, whole: Column) -> Column:
    """floor(total * part / whole + 1/2) without leaving the integers; whole > 0."""
    n = total * part * 2 + whole
    d = whole * 2
    return F.call_function("div", n - F.pmod(n, d), d)


def proportional_cents(total: Column, part: Column, whole: Column) -> Column:
    """``part``'s share of ``total`` when the parts add up to ``whole``, in whole cents.

    A missing or zero ``whole`` gives 0. Ordinary amounts stay in bigint
    arithmetic; only very large ones take the decimal path.
    """
    small = (F.abs(total) < _SMALL) & (F.abs(part) < _SMALL) & (whole < (1 << 60))
    big = "decimal(20,0)"
    return (
        F.when(F.coalesce(whole, F.lit(0)) <= 0, F.lit(0).cast("bigint"))
        .when(small, _rounded_quotient(total, part, whole))
        .otherwise(_rounded_quotient(total.cast(big), part.cast(big), whole.cast(big)))
    )
