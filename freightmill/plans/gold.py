"""Gold tables: totals per fact key, then the dimension's columns, then the ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightmill.contracts import AGG_CARRIER_SCORECARD
from freightmill.functions.labels import BADGE_BREACH, BADGE_COMPLIANT, is_delayed
from freightmill.functions.numeric import half_up, ratio
from freightmill.functions.temporal import month_label, month_start
from freightmill.operators.tally import mean_of, pct_of_shipments, tally


def carrier_scorecard(fact: DataFrame, carriers: DataFrame) -> DataFrame:
    return carrier_sheet(tally(fact, "carrier_id"), carriers)


def carrier_sheet(totals: DataFrame, carriers: DataFrame) -> DataFrame:
    """The scorecard from totals by carrier."""
    scored = totals.join(
        carriers.select("carrier_id", "carrier_name", "transport_mode", "sla_target_pct"),
        "carrier_id",
    )
    sheet = scored.select(
        "carrier_id",
        "carrier_name",
        "transport_mode",
        "sla_target_pct",
        F.col("shipments").alias("total_shipments"),
        F.col("on_time").alias("on_time_shipments"),
        F.col("in_full").alias("in_full_shipments"),
        F.col("otif").alias("otif_shipments"),
        mean_of("transit").alias("avg_transit_days"),
        mean_of("delay").alias("avg_delay_days"),
        F.col("freight").alias("total_freight_spend_usd"),
        pct_of_shipments("on_time").alias("actual_on_time_pct"),
        pct_of_shipments("otif").alias("actual_otif_pct"),
    )
    missed = F.col("actual_on_time_pct") < F.col("sla_target_pct")
    return sheet.withColumn("sla_breach_flag", F.when(missed, 1).otherwise(0))


def with_breach_badge(scorecard: DataFrame) -> DataFrame:
    badge = F.when(F.col("sla_breach_flag") == 1, BADGE_BREACH).otherwise(BADGE_COMPLIANT)
    return scorecard.withColumn("sla_badge", badge)


def agg_carrier_scorecard(scorecard: DataFrame) -> DataFrame:
    """The warehouse's aggregate table: contract types and the load time."""
    typed = [F.col(a.name).cast(a.dtype).alias(a.name) for a in AGG_CARRIER_SCORECARD.attributes]
    return scorecard.select(*typed, F.localtimestamp().alias("updated_at"))


def _warehouse_months(fact: DataFrame) -> DataFrame:
    """Totals per warehouse and month of delivery."""
    month = month_start(F.col("actual_delivery_date")).alias("delivery_month_start")
    return tally(fact, "destination_warehouse_id", month)


def warehouse_monthly(fact: DataFrame, warehouses: DataFrame) -> DataFrame:
    return warehouse_sheet(_warehouse_months(fact), warehouses)


def warehouse_sheet(totals: DataFrame, warehouses: DataFrame) -> DataFrame:
    """The monthly table from totals by warehouse and month of delivery."""
    month = month_label(F.col("delivery_month_start")).alias("delivery_month")
    return _warehouse_sheet(totals, warehouses, month)


def warehouse_monthly_by_date(fact: DataFrame, warehouses: DataFrame) -> DataFrame:
    """The same table keyed by the first day of the month."""
    return _warehouse_sheet(_warehouse_months(fact), warehouses, F.col("delivery_month_start"))


def _warehouse_sheet(totals: DataFrame, warehouses: DataFrame, month: Column) -> DataFrame:
    described = totals.join(
        warehouses.select("warehouse_id", "name", "region"),
        F.col("destination_warehouse_id") == F.col("warehouse_id"),
    )
    return described.select(
        "warehouse_id",
        "name",
        "region",
        month,
        F.col("shipments").alias("monthly_inbound_shipments"),
        F.col("weight").alias("total_inbound_weight_kg"),
        F.col("freight").alias("monthly_freight_cost_usd"),
        pct_of_shipments("otif").alias("monthly_otif_pct"),
    )


def supplier_reliability(fact: DataFrame, suppliers: DataFrame) -> DataFrame:
    return supplier_sheet(tally(fact, "supplier_id"), suppliers)


def supplier_sheet(totals: DataFrame, suppliers: DataFrame) -> DataFrame:
    """The reliability table from totals by supplier."""
    described = suppliers.select(
        "supplier_id",
        "supplier_name",
        "category",
        "country",
        "agreed_lead_days",
        "reliability_rating",
    )
    return totals.join(described, "supplier_id").select(
        *described.columns,
        F.col("shipments").alias("total_orders"),
        mean_of("transit").alias("avg_actual_lead_days"),
        pct_of_shipments("damaged").alias("damage_rate_pct"),
        pct_of_shipments("otif").alias("supplier_otif_pct"),
    )


def _delay_counts(fact: DataFrame) -> DataFrame:
    return (
        fact.filter(is_delayed(F.col("delay_reason")))
        .groupBy(F.col("delay_reason").alias("reason"))
        .agg(F.count(F.lit(1)).alias("count"))
    )


def delay_breakdown(fact: DataFrame) -> DataFrame:
    """Shipments per delay reason, most frequent first, ties by name."""
    return _delay_counts(fact).orderBy(F.desc("count"), "reason")


def delay_sheet(totals: DataFrame) -> DataFrame:
    """The breakdown from totals by delay reason."""
    late = totals.filter(is_delayed(F.col("delay_reason")))
    counts = late.select(F.col("delay_reason").alias("reason"), F.col("shipments").alias("count"))
    return counts.orderBy(F.desc("count"), "reason")


def delay_breakdown_pct(fact: DataFrame) -> DataFrame:
    """Each reason's count as a whole-number share of the largest one."""
    counts = _delay_counts(fact)
    largest = counts.agg(F.max("count")).scalar()
    share = half_up(ratio(F.col("count"), largest) * 100, 0).cast("int")
    sheet = counts.select("reason", "count", share.alias("pct_of_max"))
    return sheet.orderBy(F.desc("count"), "reason")
