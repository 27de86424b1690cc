"""Table contracts: column types, keys, domains and where each feed comes from.

Text limits, 0/1 flags and unique keys are rules Spark does not enforce on
Parquet; they are kept here as data and checked by ``operators.quality``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Attribute:
    name: str
    dtype: T.DataType
    required: bool = True
    max_length: int | None = None
    is_flag: bool = False


@dataclass(frozen=True)
class Contract:
    name: str
    attributes: tuple[Attribute, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    source_system: str | None = None

    @property
    def columns(self) -> list[str]:
        return [a.name for a in self.attributes]

    @property
    def required(self) -> list[str]:
        return [a.name for a in self.attributes if a.required]

    @property
    def struct(self) -> T.StructType:
        """Read-side schema; nullability is a rule to check, not to assume."""
        return T.StructType([T.StructField(a.name, a.dtype, True) for a in self.attributes])

    def plus(self, name: str, *more: Attribute, **changes) -> "Contract":
        return Contract(
            name,
            self.attributes + more,
            changes.get("unique", self.unique),
            changes.get("source_system", self.source_system),
        )


def _text(name: str, limit: int, required: bool = True) -> Attribute:
    return Attribute(name, T.StringType(), required, max_length=limit)


def _int(name: str) -> Attribute:
    return Attribute(name, T.IntegerType())


def _big(name: str) -> Attribute:
    return Attribute(name, T.LongType())


def _dec(name: str, precision: int, scale: int) -> Attribute:
    return Attribute(name, T.DecimalType(precision, scale))


def _flag(name: str) -> Attribute:
    return Attribute(name, T.IntegerType(), is_flag=True)


def _real(name: str) -> Attribute:
    return Attribute(name, T.DoubleType())


# Civil date-times carry no zone in the warehouse, so no session zone can move them.
def _datetime(name: str, required: bool = True) -> Attribute:
    return Attribute(name, T.TimestampNTZType(), required)


def _date(name: str) -> Attribute:
    return Attribute(name, T.DateType())


CARRIERS = Contract(
    "carriers",
    (
        _text("carrier_id", 50),
        _text("carrier_name", 100),
        _text("transport_mode", 50),
        _dec("base_rate_per_kg", 10, 4),
        _dec("sla_target_pct", 5, 2),
    ),
    unique=(("carrier_id",),),
    source_system="ERP",
)

WAREHOUSES = Contract(
    "warehouses",
    (
        _text("warehouse_id", 50),
        _text("name", 100),
        _text("city", 100),
        _text("country", 100),
        _text("region", 50),
        _big("capacity_sqft"),
        _dec("daily_op_cost_usd", 12, 2),
    ),
    unique=(("warehouse_id",),),
    source_system="WMS",
)

SUPPLIERS = Contract(
    "suppliers",
    (
        _text("supplier_id", 50),
        _text("supplier_name", 150),
        _text("category", 100),
        _text("country", 100),
        _int("agreed_lead_days"),
        _dec("reliability_rating", 4, 2),
        _dec("contract_sla_pct", 5, 2),
    ),
    unique=(("supplier_id",),),
    source_system="SRM",
)

SHIPMENTS = Contract(
    "shipments",
    (
        _text("shipment_id", 50),
        _text("order_id", 50),
        _text("supplier_id", 50),
        _text("destination_warehouse_id", 50),
        _text("carrier_id", 50),
        _datetime("order_date"),
        _date("promised_delivery_date"),
        _date("actual_delivery_date"),
        _int("transit_days"),
        _int("promised_transit_days"),
        _flag("on_time_flag"),
        _flag("in_full_flag"),
        _dec("weight_kg", 10, 2),
        _int("quantity_units"),
        _dec("freight_cost_usd", 12, 2),
        _flag("damage_reported_flag"),
        _text("delay_reason", 100, required=False),
        _text("shipment_status", 50),
    ),
    unique=(("shipment_id",),),
    source_system="TMS",
)

TELEMATICS = Contract(
    "fleet_telematics",
    (
        _text("telematics_id", 50),
        _text("vehicle_id", 50),
        Attribute("timestamp", T.TimestampType()),
        _real("speed_kmh"),
        _real("fuel_consumption_l_100km"),
        _real("engine_temp_celsius"),
        _int("idle_minutes_today"),
        _flag("maintenance_alert_flag"),
        _real("gps_latitude"),
        _real("gps_longitude"),
    ),
    unique=(("telematics_id",),),
    source_system="IoT_Hub",
)

FEEDS = {c.name: c for c in (CARRIERS, WAREHOUSES, SUPPLIERS, SHIPMENTS, TELEMATICS)}

SILVER_CARRIERS = CARRIERS.plus("silver_carriers", _text("carrier_tier", 50))
SILVER_WAREHOUSES = WAREHOUSES.plus("silver_warehouses", _dec("cost_per_sqft", 10, 2))
SILVER_SUPPLIERS = SUPPLIERS.plus("silver_suppliers", _text("risk_profile", 50))

DIM_CARRIER = SILVER_CARRIERS.plus(
    "dim_carrier", _datetime("effective_start_date", required=False), _flag("is_active")
)
DIM_WAREHOUSE = SILVER_WAREHOUSES.plus("dim_warehouse")
DIM_SUPPLIER = SILVER_SUPPLIERS.plus("dim_supplier")

DIM_DATE = Contract(
    "dim_date",
    (
        _int("date_key"),
        _date("full_date"),
        _int("day_of_week"),
        _text("day_name", 20),
        _int("month_num"),
        _text("month_name", 20),
        _int("quarter_num"),
        _int("year_num"),
        _flag("is_weekend"),
    ),
    unique=(("date_key",), ("full_date",)),
)

# The load list of the warehouse fact, in its declared order.
FACT_SHIPMENT = Contract(
    "fact_shipment_fulfillment",
    (
        _text("shipment_id", 50),
        _text("order_id", 50),
        _text("supplier_id", 50),
        _text("destination_warehouse_id", 50),
        _text("carrier_id", 50),
        _datetime("order_date"),
        _date("promised_delivery_date"),
        _date("actual_delivery_date"),
        _int("transit_days"),
        _int("promised_transit_days"),
        _int("transit_delay_days"),
        _flag("on_time_flag"),
        _flag("in_full_flag"),
        _flag("otif_compliance_flag"),
        _dec("weight_kg", 10, 2),
        _int("quantity_units"),
        _dec("freight_cost_usd", 12, 2),
        _dec("freight_cost_per_kg", 10, 4),
        _flag("damage_reported_flag"),
        _text("delay_reason", 100, required=False),
        _text("shipment_status", 50),
    ),
    unique=(("shipment_id",),),
)

# Spend totals are wider than the declared DECIMAL(14,2): one carrier's total
# passes 10^12 USD at the data volumes this is built for.
AGG_CARRIER_SCORECARD = Contract(
    "agg_carrier_scorecard",
    (
        _text("carrier_id", 50),
        _text("carrier_name", 100),
        _text("transport_mode", 50),
        _dec("sla_target_pct", 5, 2),
        _big("total_shipments"),
        _big("on_time_shipments"),
        _big("in_full_shipments"),
        _big("otif_shipments"),
        _dec("avg_transit_days", 6, 2),
        _dec("avg_delay_days", 6, 2),
        _dec("total_freight_spend_usd", 22, 2),
        _dec("actual_on_time_pct", 5, 2),
        _dec("actual_otif_pct", 5, 2),
        _flag("sla_breach_flag"),
    ),
    unique=(("carrier_id",),),
)
