"""The same period one year earlier, at year, month or day grain.

Each row is emitted as itself and as the prior of the periods that follow it a year
later, and the two meet in one aggregation: the series is computed once, with no
self-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightmill.functions.temporal import same_day_last_year


def with_prior_year(series: DataFrame, year: str, rest: list[str], value: str) -> DataFrame:
    """Add ``prior_<value>`` from the row with ``year - 1`` and equal ``rest`` keys."""
    kind = series.schema[year].dataType
    following = F.array((F.col(year) + 1).cast(kind))
    return _with_prior(series, year, rest, value, following)


def with_prior_year_daily(
    series: DataFrame, day: str, rest: list[str], value: str
) -> DataFrame:
    """Day grain. A day's prior is the day twelve months back, so 28 February of a
    common year is the prior of both 28 and 29 February of a leap year after it."""
    ahead = F.add_months(F.col(day), 12)
    following = F.filter(
        F.array(ahead, F.date_add(ahead, 1)), lambda d: same_day_last_year(d) == F.col(day)
    )
    return _with_prior(series, day, rest, value, following)


def _with_prior(
    series: DataFrame, period: str, rest: list[str], value: str, following: Column
) -> DataFrame:
    keys = [period, *rest]
    carried = [c for c in series.columns if c not in keys]

    def emitted(at: Column, own: bool) -> Column:
        """One output row: the period's own columns, or its value as someone's prior."""
        def empty(name: str) -> Column:
            return F.lit(None).cast(series.schema[name].dataType)

        return F.struct(
            at.alias(period),
            *[F.col(c) for c in rest],
            *[(F.col(c) if own else empty(c)).alias(c) for c in carried],
            (empty(value) if own else F.col(value)).alias(f"prior_{value}"),
            F.lit(own).alias("_own"),
        )

    rows = F.concat(
        F.array(emitted(F.col(period), own=True)),
        F.transform(following, lambda at: emitted(at, own=False)),
    )
    # A key has one row of its own and at most one prior, so max only skips the NULLs.
    return (
        series.select(F.inline(rows))
        .groupBy(*keys)
        .agg(
            *[F.max(c).alias(c) for c in carried],
            F.max(f"prior_{value}").alias(f"prior_{value}"),
            F.max("_own").alias("_own"),
        )
        .filter("_own")
        .drop("_own")
    )
