"""Small frames and comparison helpers shared by the tests."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal

SMALL = "/root/testdata/sf0.001"

SHIPMENT_DDL = (
    "shipment_id STRING, order_id STRING, supplier_id STRING, destination_warehouse_id STRING, "
    "carrier_id STRING, order_date TIMESTAMP_NTZ, promised_delivery_date DATE, "
    "actual_delivery_date DATE, transit_days INT, promised_transit_days INT, on_time_flag INT, "
    "in_full_flag INT, weight_kg DECIMAL(10,2), quantity_units INT, "
    "freight_cost_usd DECIMAL(12,2), damage_reported_flag INT, delay_reason STRING, "
    "shipment_status STRING"
)


def shipment(i=1, **changes):
    row = {
        "shipment_id": f"S{i}",
        "order_id": f"O{i}",
        "supplier_id": "P1",
        "destination_warehouse_id": "W1",
        "carrier_id": "C1",
        "order_date": datetime(2024, 3, 1, 8, 30, 0),
        "promised_delivery_date": date(2024, 3, 6),
        "actual_delivery_date": date(2024, 3, 5),
        "transit_days": 4,
        "promised_transit_days": 5,
        "on_time_flag": 1,
        "in_full_flag": 1,
        "weight_kg": Decimal("100.00"),
        "quantity_units": 10,
        "freight_cost_usd": Decimal("250.00"),
        "damage_reported_flag": 0,
        "delay_reason": "None",
        "shipment_status": "Delivered",
    }
    row.update(changes)
    return tuple(row.values())


def shipments(spark, *rows):
    return spark.createDataFrame(list(rows), SHIPMENT_DDL)


def values(frame, *columns):
    """Rows as sorted tuples of the named columns (all when none are named)."""
    chosen = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, (float, Decimal)):
        return f"{float(value):.9g}"
    return str(value)


def plan_text(frame):
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
