"""The logistics semantic model: relationships and the registered measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightmill.functions.labels import MEASURE_BREACH, MEASURE_COMPLIANT
from freightmill.functions.numeric import ratio
from freightmill.operators.batch_replace import DAY_PARTITION
from freightmill.operators.day_tally import MEASURE_KEYS
from freightmill.operators.measures import (
    Average,
    DimensionAverage,
    Formula,
    Measure,
    Model,
    Relationship,
    Rollup,
    Rows,
    Total,
    YearOnYear,
)
from freightmill.operators.tally import KNOWN_ROWS, ROWS, TOTALS

FACT = "fact_shipment_fulfillment"
FLEET = "fact_fleet_telematics"

RELATIONSHIPS = (
    Relationship("dim_date", "full_date", FACT, "actual_delivery_date"),
    Relationship("dim_date", "full_date", FACT, "order_date", active=False, as_date=True),
    Relationship("dim_carrier", "carrier_id", FACT, "carrier_id"),
    Relationship("dim_warehouse", "warehouse_id", FACT, "destination_warehouse_id"),
    Relationship("dim_supplier", "supplier_id", FACT, "supplier_id"),
)


def equal_to(value: int | str):
    return lambda c: c == value


def above(value: float):
    return lambda c: c > value


def one_of(*values):
    return lambda c: c.isin(*values)


def between(low, high):
    return lambda c: c.between(low, high)


def _or_zero(part: Column, whole: Column) -> Column:
    return ratio(part, whole, alternate=0)


def _breach(rate: Column, target: Column) -> Column:
    return F.when(rate < target, MEASURE_BREACH).otherwise(MEASURE_COMPLIANT)


MEASURES: dict[str, Measure] = {
    "total_shipments": Rows(FACT),
    "total_freight_spend_usd": Total(f"{FACT}.freight_cost_usd"),
    "total_weight_kg": Total(f"{FACT}.weight_kg"),
    "freight_cost_per_kg_weighted": Formula(
        ("total_freight_spend_usd", "total_weight_kg"), _or_zero
    ),
    "avg_transit_days": Average(f"{FACT}.transit_days"),
    "avg_transit_delay_days": Average(f"{FACT}.transit_delay_days"),
    "on_time_shipments": Rows(FACT, {f"{FACT}.on_time_flag": equal_to(1)}),
    "in_full_shipments": Rows(FACT, {f"{FACT}.in_full_flag": equal_to(1)}),
    "otif_shipments": Rows(FACT, {f"{FACT}.otif_compliance_flag": equal_to(1)}),
    "damaged_shipments": Rows(FACT, {f"{FACT}.damage_reported_flag": equal_to(1)}),
    "on_time_rate": Formula(("on_time_shipments", "total_shipments"), _or_zero),
    "otif_rate": Formula(("otif_shipments", "total_shipments"), _or_zero),
    "damage_rate": Formula(("damaged_shipments", "total_shipments"), _or_zero),
    "target_sla": DimensionAverage("dim_carrier.sla_target_pct", divisor=100.0),
    "sla_variance": Formula(("on_time_rate", "target_sla"), lambda rate, target: rate - target),
    "sla_breach_status": Formula(("on_time_rate", "target_sla"), _breach),
    "freight_yoy_growth": YearOnYear("total_freight_spend_usd"),
    "avg_vehicle_speed_kmh": Average(f"{FLEET}.speed_kmh"),
    "avg_fuel_moving_l_100km": Average(
        f"{FLEET}.fuel_consumption_l_100km", {f"{FLEET}.speed_kmh": above(5)}
    ),
    "active_maintenance_alerts": Rows(FLEET, {f"{FLEET}.maintenance_alert_flag": equal_to(1)}),
}


def logistics_model(**tables: DataFrame) -> Model:
    """Tables by their model name (``dim_carrier``, ``fact_shipment_fulfillment``, ...);
    give only those the evaluation touches."""
    return Model(tables, RELATIONSHIPS, MEASURES)


def shipment_rollup(totals: DataFrame) -> Rollup:
    """Day totals of the grain "measure" as something the measures can be answered from."""
    return Rollup(
        FACT,
        totals,
        frozenset(MEASURE_KEYS),
        ROWS,
        sums={column: total for total, column in TOTALS.items()},
        present={column: n for n, column in KNOWN_ROWS.items()},
        days={"order_date": DAY_PARTITION},
    )
