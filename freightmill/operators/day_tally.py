"""Totals kept by order day, so that new shipments cost only the days they fall on.

Totals are additive: a report is the sum of its days' totals, and a day that changed is tallied
again and takes the place of its old totals. A day's totals have as many rows as it has keys.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightmill.functions.temporal import month_start
from freightmill.operators.batch_replace import DAY_PARTITION, order_day
from freightmill.operators.tally import merge_tallies, tally

MONTH = "delivery_month_start"
#: What measures are asked by most: the carrier, the day of delivery and the flags they filter.
MEASURE_KEYS = [
    "carrier_id", "actual_delivery_date", "on_time_flag", "in_full_flag",
    "otif_compliance_flag", "damage_reported_flag",
]


def grain_keys(grain: str) -> list[str | Column]:
    """What the totals of a grain are kept by, besides the order day."""
    return {
        "carrier": ["carrier_id"],
        "warehouse": [
            "destination_warehouse_id", month_start(F.col("actual_delivery_date")).alias(MONTH)
        ],
        "supplier": ["supplier_id"],
        "reason": ["delay_reason"],
        "measure": MEASURE_KEYS,
    }[grain]


#: Grain -> its key columns as stored.
GRAINS = {
    "carrier": ["carrier_id"],
    "warehouse": ["destination_warehouse_id", MONTH],
    "supplier": ["supplier_id"],
    "reason": ["delay_reason"],
    "measure": MEASURE_KEYS,
}


def on_days(frame: DataFrame, days: list[date | None]) -> Column:
    """Is the row's order day one of ``days``? A literal test, so that a table laid out by day
    is read in these folders only; None stands for rows without an order day."""
    day = order_day(frame)
    known = [d for d in days if d is not None]
    test = day.isin(known) if known else F.lit(False)
    # NULL for a row without a day, which a filter takes for no.
    return test | day.isNull() if None in days else test


def day_tally(fact: DataFrame, grain: str) -> DataFrame:
    """One row for each order day and key of the grain."""
    return tally(fact, order_day(fact).alias(DAY_PARTITION), *grain_keys(grain))


def replace_days(stored: DataFrame, fresh: DataFrame, days: list[date | None]) -> DataFrame:
    """The totals after ``days`` were tallied again, as a plan; ``fresh`` holds those days."""
    kept = stored.filter(~F.coalesce(on_days(stored, days), F.lit(False)))
    return kept.unionByName(fresh)


def over_days(totals: DataFrame, *keys: str) -> DataFrame:
    """Totals by ``keys`` over all days, in the types they have when tallied at once."""
    merged = merge_tallies(totals, *keys)
    return merged.select(
        *keys, *[F.col(c).cast(totals.schema[c].dataType) for c in merged.columns if c not in keys]
    )
