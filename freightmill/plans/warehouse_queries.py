"""The four reporting queries over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freightmill.functions.labels import (
    QUERY_BREACH,
    QUERY_COMPLIANT,
    RISK_MATRIX_MIN_ORDERS,
)
from freightmill.functions.numeric import mean
from freightmill.operators.tally import mean_of, pct_of_shipments, tally


def exec_kpi_summary(fact: DataFrame) -> DataFrame:
    """One row of headline figures. Cost per kg is the mean of the row ratios."""
    totals = fact.agg(
        F.count("shipment_id").alias("shipments"),
        F.sum("freight_cost_usd").alias("freight"),
        F.sum("freight_cost_per_kg").alias("unit_cost_sum"),
        F.count("freight_cost_per_kg").alias("unit_cost_rows"),
        F.sum("otif_compliance_flag").alias("otif"),
        F.sum("damage_reported_flag").alias("damaged"),
        F.sum("transit_delay_days").alias("delay_sum"),
        F.count("transit_delay_days").alias("delay_rows"),
    )
    unit_cost = mean(F.col("unit_cost_sum"), F.col("unit_cost_rows"), 4)
    return totals.select(
        F.col("shipments").alias("total_shipments"),
        F.col("freight").alias("total_freight_spend_usd"),
        unit_cost.alias("avg_freight_cost_per_kg"),
        pct_of_shipments("otif").alias("otif_compliance_rate_pct"),
        pct_of_shipments("damaged").alias("damage_rate_pct"),
        mean_of("delay").alias("avg_transit_delay_days"),
    )


def carrier_sla_ranking(fact: DataFrame, carriers: DataFrame) -> DataFrame:
    """Carriers ranked inside their transport mode by the rounded on-time-in-full rate."""
    described = carriers.select(
        "carrier_id", "carrier_name", "transport_mode", "carrier_tier", "sla_target_pct"
    )
    scored = tally(fact, "carrier_id").join(described, "carrier_id").select(
        *described.columns,
        F.col("shipments").alias("total_shipments"),
        pct_of_shipments("on_time").alias("actual_ontime_pct"),
        pct_of_shipments("otif").alias("actual_otif_pct"),
    )
    late = F.col("actual_ontime_pct") < F.col("sla_target_pct")
    in_mode = Window.partitionBy("transport_mode").orderBy(F.desc("actual_otif_pct"))
    return scored.select(
        "*",
        F.when(late, QUERY_BREACH).otherwise(QUERY_COMPLIANT).alias("sla_status"),
        F.rank().over(in_mode).alias("mode_rank"),
    ).orderBy(F.desc("actual_otif_pct"), "carrier_id")


def warehouse_efficiency(fact: DataFrame, warehouses: DataFrame) -> DataFrame:
    described = warehouses.select("region", "warehouse_id", "name", "cost_per_sqft")
    return (
        tally(fact, "destination_warehouse_id")
        .join(described, F.col("destination_warehouse_id") == F.col("warehouse_id"))
        .select(
            "region",
            "warehouse_id",
            F.col("name").alias("warehouse_name"),
            F.col("shipments").alias("inbound_shipments"),
            F.col("weight").alias("total_inbound_weight_kg"),
            F.col("freight").alias("total_freight_spend_usd"),
            pct_of_shipments("otif").alias("warehouse_otif_pct"),
            F.col("cost_per_sqft").alias("facility_cost_per_sqft"),
        )
        .orderBy(F.desc("total_freight_spend_usd"), "warehouse_id")
    )


def supplier_risk_matrix(
    fact: DataFrame, suppliers: DataFrame, min_orders: int = RISK_MATRIX_MIN_ORDERS
) -> DataFrame:
    """Suppliers with enough orders to judge, worst damage rate first."""
    described = suppliers.select(
        "supplier_id", "supplier_name", "country", "category", "risk_profile"
    )
    return (
        tally(fact, "supplier_id")
        .filter(F.col("shipments") >= min_orders)
        .join(described, "supplier_id")
        .select(
            *described.columns,
            F.col("shipments").alias("order_count"),
            pct_of_shipments("damaged").alias("damage_rate_pct"),
            mean_of("delay").alias("avg_delay_days"),
        )
        .orderBy(F.desc("damage_rate_pct"), F.desc("avg_delay_days"), "supplier_id")
    )
