"""Reports as a restricted user sees them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightmill.operators.access import permitted, visible
from freightmill.operators.tally import pct_of_shipments, tally


def regional_manager_view(
    fact: DataFrame, warehouses: DataFrame, entitlements: DataFrame, user: str
) -> DataFrame:
    """Per-warehouse figures of the regions granted to ``user``."""
    allowed = permitted(warehouses, entitlements, user, "region")
    totals = visible(
        tally(fact, "destination_warehouse_id"), "destination_warehouse_id", allowed, "warehouse_id"
    )
    return totals.select(
        F.col("destination_warehouse_id").alias("warehouse_id"),
        "shipments",
        F.col("freight").alias("freight_cost_usd"),
        pct_of_shipments("otif").alias("otif_pct"),
    )


def supplier_manager_view(
    fact: DataFrame, suppliers: DataFrame, entitlements: DataFrame, user: str
) -> DataFrame:
    """Per-supplier figures of the categories granted to ``user``."""
    allowed = permitted(suppliers, entitlements, user, "category")
    totals = visible(tally(fact, "supplier_id"), "supplier_id", allowed, "supplier_id")
    return totals.select(
        "supplier_id",
        "shipments",
        pct_of_shipments("damaged").alias("damage_rate_pct"),
        pct_of_shipments("otif").alias("otif_pct"),
    )
