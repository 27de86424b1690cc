"""Dates without a session time zone in the loop."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# A time followed by Z or by an offset such as +05:00.
ZONED = r"\d:\d{2}.*(?:[zZ]|[+-]\d{2}(?::?\d{2})?)\s*$"


def civil_datetime(value: Column) -> Column:
    """Text (or an already typed column) to a zone-less timestamp; NULL if unreadable.

    A text that names its offset is an instant and becomes the UTC time of that instant.
    """
    instant = value.try_cast("timestamp").cast("timestamp_ntz")
    in_utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant)
    zoned = value.cast("string").rlike(ZONED)
    return F.when(zoned, in_utc).otherwise(value.try_cast("timestamp_ntz"))


def civil_date(value: Column) -> Column:
    return civil_datetime(value).cast("date")


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_label(day: Column) -> Column:
    """'yyyy-MM'. Format after grouping by ``month_start``, not once per fact row."""
    return F.date_format(day, "yyyy-MM")


def second_stamp(moment: Column) -> Column:
    """'yyyy-MM-dd HH:mm:ss' of a zone-less timestamp."""
    return F.substring(moment.cast("string"), 1, 19)


def same_day_last_year(day: Column) -> Column:
    return F.add_months(day, -12)
