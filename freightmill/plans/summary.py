"""The summary document, as one small dataset per part.

The parts are written side by side rather than as one nested JSON object: the
warehouse part grows with warehouses and months, and one object would pass it all
through a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightmill.functions.labels import damage_status, otif_status, target_status
from freightmill.functions.numeric import half_up
from freightmill.operators.day_tally import over_days
from freightmill.operators.tally import mean_of, pct_of_shipments, tally
from freightmill.plans.gold import delay_sheet
from freightmill.sources.lake import write_json_lines

TOP_SUPPLIERS = 15
TOP_CARRIERS = 6
SHOWN_WAREHOUSE_MONTHS = 15


def _rows(frame: DataFrame):
    return frame.agg(F.count(F.lit(1)).alias("n")).scalar()


def summary_kpis(fact: DataFrame, suppliers: DataFrame, warehouses: DataFrame) -> DataFrame:
    """One row; spend in millions."""
    return kpi_sheet(tally(fact), suppliers, warehouses)


def kpi_sheet(totals: DataFrame, suppliers: DataFrame, warehouses: DataFrame) -> DataFrame:
    """The same from the totals of all shipments."""
    otif = pct_of_shipments("otif", 1)
    return totals.select(
        F.col("shipments").alias("total_shipments"),
        otif.alias("otif_rate_pct"),
        half_up(F.col("freight") / F.lit(1000000), 2).alias("total_freight_spend_musd"),
        mean_of("transit", 1).alias("avg_transit_days"),
        pct_of_shipments("damaged").alias("damage_rate_pct"),
        _rows(suppliers).alias("active_suppliers"),
        _rows(warehouses).alias("active_warehouses"),
        otif_status(otif).alias("otif_status"),
    )


def top_suppliers(reliability: DataFrame, n: int = TOP_SUPPLIERS) -> DataFrame:
    return reliability.orderBy(F.desc("total_orders"), "supplier_id").limit(n)


def carriers_by_volume(scorecard: DataFrame, n: int | None = None) -> DataFrame:
    """Busiest carriers with the target status of their on-time-in-full rate."""
    status = target_status(F.col("actual_otif_pct"), F.col("sla_target_pct"))
    ranked = scorecard.withColumn("otif_target_status", status).orderBy(
        F.desc("total_shipments"), "carrier_id"
    )
    return ranked if n is None else ranked.limit(n)


def warehouse_status(monthly: DataFrame, n: int = SHOWN_WAREHOUSE_MONTHS) -> DataFrame:
    """The first warehouse-months in key order, as the summary page lists them."""
    keys = ["warehouse_id", "name", "region", "delivery_month"]
    status = otif_status(F.col("monthly_otif_pct"))
    return monthly.orderBy(*keys).limit(n).withColumn("otif_status", status)


def supplier_damage(reliability: DataFrame) -> DataFrame:
    return reliability.withColumn("damage_status", damage_status(F.col("damage_rate_pct")))


def summary_parts(
    reasons: DataFrame, warehouses: DataFrame, suppliers: DataFrame, gold: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """The parts, from the gold tables and the totals by delay reason, which have every shipment."""
    return {
        "kpis": kpi_sheet(over_days(reasons), suppliers, warehouses).withColumn(
            "generated_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
        ),
        "carrier_scorecard": gold["gold_carrier_scorecard"],
        "warehouse_summary": gold["gold_warehouse_monthly"],
        "supplier_summary": top_suppliers(gold["gold_supplier_reliability"]),
        "delay_breakdown": delay_sheet(reasons),
    }


def write_summary(parts: dict[str, DataFrame], folder: str) -> None:
    for name, part in parts.items():
        write_json_lines(part, f"{folder}/{name}")
