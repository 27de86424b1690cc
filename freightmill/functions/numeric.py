"""Division and rounding with one meaning on every engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A ratio is rounded from its ten-digit decimal image, so that 12.345 held as
# 12.344999999999999 still rounds half-up to 12.35.
IMAGE = "decimal(28,10)"


def half_up(value: Column, places: int) -> Column:
    return F.round(value.cast(IMAGE), places)


def ratio(numerator: Column, denominator: Column, alternate: float | None = None) -> Column:
    """Double quotient; NULL (or ``alternate``) where the denominator is 0 or NULL."""
    quotient = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return quotient if alternate is None else F.coalesce(quotient, F.lit(float(alternate)))


def mean(total: Column, rows: Column, places: int) -> Column:
    return half_up(ratio(total, rows), places)


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    return half_up(ratio(part, whole) * 100, places)


def rounded_ratio_sql(numerator: str, denominator: str, factor: int, places: int) -> str:
    """``mean`` (factor 1) and ``percent`` (factor 100) as SQL text, for wide select lists."""
    quotient = f"try_divide(CAST({numerator} AS DOUBLE), CAST({denominator} AS DOUBLE))"
    return f"round(CAST({quotient} * {factor} AS {IMAGE}), {places})"
