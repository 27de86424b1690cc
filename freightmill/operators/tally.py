"""Additive totals of the shipment fact.

Every report is a ratio or a sum of these totals. The fact is therefore grouped by
its own key first: the map side combines rows before the shuffle (a key holding a
third of the fact leaves each task as one row), and only one row per key is joined
to a dimension. Totals nobody reads are pruned by the optimizer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightmill.functions.numeric import rounded_ratio_sql

TOTALS = {
    "on_time": "on_time_flag",
    "in_full": "in_full_flag",
    "otif": "otif_compliance_flag",
    "damaged": "damage_reported_flag",
    "transit_sum": "transit_days",
    "delay_sum": "transit_delay_days",
    "weight": "weight_kg",
    "freight": "freight_cost_usd",
}
#: How many rows a mean divides by: those whose value is known.
KNOWN_ROWS = {"transit_rows": "transit_days", "delay_rows": "transit_delay_days"}
#: The count of all rows.
ROWS = "shipments"


def tally(fact: DataFrame, *keys: str | Column) -> DataFrame:
    """One row per key with ``shipments`` and the totals above."""
    have = set(fact.columns)
    sums = [f"sum({column}) AS {total}" for total, column in TOTALS.items() if column in have]
    rows = [f"count({column}) AS {n}" for n, column in KNOWN_ROWS.items() if column in have]
    return _grouped(fact, keys, ["count(*) AS shipments", *sums, *rows])


def merge_tallies(totals: DataFrame, *keys: str | Column) -> DataFrame:
    """Regroup tallies to coarser keys."""
    have = set(totals.columns)
    names = [n for n in ("shipments", *TOTALS, *KNOWN_ROWS) if n in have]
    return _grouped(totals, keys, [f"sum({n}) AS {n}" for n in names])


def _grouped(frame: DataFrame, keys: tuple[str | Column, ...], aggregates: list[str]) -> DataFrame:
    return frame.groupBy(*keys).agg(*[F.expr(a) for a in aggregates])


def pct_of_shipments(total: str, places: int = 2) -> Column:
    return F.expr(rounded_ratio_sql(total, "shipments", 100, places))


def mean_of(quantity: str, places: int = 2) -> Column:
    """Mean of "transit" or "delay" days over the shipments where they are known."""
    return F.expr(rounded_ratio_sql(f"{quantity}_sum", f"{quantity}_rows", 1, places))
