"""The date dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dim_date(bounds: DataFrame) -> DataFrame:
    """One row per day of every calendar year touched by ``bounds`` (first_day, last_day).

    ``day_of_week`` counts from Sunday = 1.
    """
    first = F.trunc("first_day", "YEAR")
    last = F.date_add(F.add_months(F.trunc("last_day", "YEAR"), 12), -1)
    days = bounds.select(F.explode(F.sequence(first, last)).alias("full_date"))
    return with_date_columns(days)


def with_date_columns(days: DataFrame) -> DataFrame:
    """Rows with a ``full_date``, described as the date dimension describes that day.

    What is already grouped by day needs no calendar to join: its columns follow from the day,
    and no table has to be searched for the first and the last one.
    """
    d = F.col("full_date")
    week_day = F.dayofweek(d)
    described = {
        "date_key": F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d),
        "day_of_week": week_day,
        "day_name": F.date_format(d, "EEEE"),
        "month_num": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "quarter_num": F.quarter(d),
        "year_num": F.year(d),
        "is_weekend": F.when(week_day.isin(1, 7), 1).otherwise(0),
    }
    others = [c for c in days.columns if c != "full_date"]
    return days.select(
        described["date_key"].alias("date_key"),
        "full_date",
        *[value.alias(name) for name, value in described.items() if name != "date_key"],
        *others,
    )
