"""Ratios, rounding and clipping with explicit NULL and zero rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ratio(numerator: Column, denominator: Column, scale: float = 1.0) -> Column:
    """``scale * numerator / denominator``; NULL where the denominator is zero or NULL."""
    return F.try_divide(F.lit(float(scale)) * numerator, denominator.cast("double"))


def pct(numerator: Column, denominator: Column, places: int = 2) -> Column:
    """Percentage, rounded half away from zero as SQL does."""
    return F.round(ratio(numerator, denominator, 100.0), places)


def pct_even(numerator: Column, denominator: Column, places: int = 1) -> Column:
    """Percentage, rounded half to even as array libraries do.

    Divides first and scales afterwards, which decides the last bit.
    """
    return F.bround(F.try_divide(numerator.cast("double"), denominator.cast("double")) * 100, places)


def or_zero(col: Column) -> Column:
    return F.coalesce(col, F.lit(0.0))


def clip(col: Column, lower=None, upper=None) -> Column:
    """Bound ``col``; NULL stays NULL (``greatest``/``least`` alone would drop it)."""
    bounded = col
    if lower is not None:
        bounded = F.greatest(bounded, lower if isinstance(lower, Column) else F.lit(lower))
    if upper is not None:
        bounded = F.least(bounded, upper if isinstance(upper, Column) else F.lit(upper))
    return F.when(col.isNotNull(), bounded)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (NULL counts as 0)."""
    return F.when(condition, 1).otherwise(0).cast("int")


def total(condition: Column) -> Column:
    """Number of rows where the condition holds, never NULL."""
    return F.count_if(condition)
