from decimal import Decimal

from helpers import shipment, shipments, values
from pyspark.sql import functions as F

from freightmill.operators.enrich import (
    enrich_carriers,
    enrich_shipments,
    enrich_suppliers,
    enrich_warehouses,
    quarantined,
    with_gate_status,
)


def test_gate_splits_without_losing_rows(spark):
    frame = shipments(
        spark, shipment(1), shipment(2, order_id=None), shipment(3, shipment_id=None)
    )
    assert values(enrich_shipments(frame), "shipment_id") == [("S1",)]
    assert quarantined(frame).count() == 2
    statuses = [r[0] for r in values(with_gate_status(frame), "gate_status")]
    assert statuses == ["ACCEPTED", "REJECTED", "REJECTED"]


def test_derived_columns(spark):
    frame = shipments(
        spark,
        shipment(1, transit_days=7, promised_transit_days=5, on_time_flag=0),
        shipment(2, in_full_flag=0),
        shipment(3, on_time_flag=None),
        shipment(4, weight_kg=Decimal("0.00")),
        shipment(5, weight_kg=Decimal("3.00"), freight_cost_usd=Decimal("0.02")),
    )
    got = values(
        enrich_shipments(frame),
        "shipment_id", "transit_delay_days", "otif_compliance_flag", "freight_cost_per_kg",
    )
    assert got == [
        ("S1", 2, 0, Decimal("2.5000")),
        ("S2", -1, 0, Decimal("2.5000")),
        ("S3", -1, 0, Decimal("2.5000")),
        ("S4", -1, 1, None),
        ("S5", -1, 1, Decimal("0.0067")),
    ]


def test_text_dates_are_parsed_in_place(spark):
    typed = shipments(spark, shipment(1))
    text = typed.withColumns(
        {c: F.col(c).cast("string") for c in ("order_date", "actual_delivery_date")}
    ).withColumn("promised_delivery_date", F.lit("next week"))
    row = enrich_shipments(text).first()
    same = enrich_shipments(typed).first()
    assert row.order_date_dt == same.order_date
    assert row.actual_delivery_dt == same.actual_delivery_date
    assert row.promised_delivery_dt is None
    assert row.shipment_hash_key == same.shipment_hash_key


def test_dimensions(spark):
    carriers = spark.sql("SELECT 'C1' AS carrier_id, CAST(94.0 AS DECIMAL(5,2)) AS sla_target_pct")
    assert enrich_carriers(carriers).first().carrier_tier == "Tier-2 Standard"
    warehouses = spark.sql(
        "SELECT CAST(10800 AS DECIMAL(12,2)) AS daily_op_cost_usd, c AS capacity_sqft "
        "FROM VALUES (420000L), (0L) AS t(c)"
    )
    assert values(enrich_warehouses(warehouses), "cost_per_sqft") == [
        (Decimal("9.39"),), (None,),
    ]
    suppliers = spark.sql("SELECT CAST(3.99 AS DECIMAL(4,2)) AS reliability_rating")
    assert enrich_suppliers(suppliers).first().risk_profile == "High Risk"
