from decimal import Decimal

from helpers import shipment, shipments, values

from freightmill.contracts import SHIPMENTS
from freightmill.operators.access import permitted, visible
from freightmill.operators.quality import (
    check_domain,
    check_not_null,
    check_references,
    check_unique,
)


def broken(report):
    return {(r.rule, r.column_name): r.violations for r in report.collect() if r.violations}


def test_not_null(spark):
    frame = shipments(
        spark, shipment(1, order_date=None, delay_reason=None), shipment(2, weight_kg=None),
        shipment(3, order_date=None),
    )
    report = check_not_null(frame, SHIPMENTS)
    assert broken(report) == {("NOT_NULL", "order_date"): 2, ("NOT_NULL", "weight_kg"): 1}
    assert {r.rows_checked for r in report.collect()} == {3}


def test_domain(spark):
    frame = shipments(
        spark, shipment(1, on_time_flag=2), shipment(2, shipment_status="x" * 51),
        shipment(3, in_full_flag=None, carrier_id="é" * 50),
    ).selectExpr("* EXCEPT (freight_cost_usd)",
                 "CAST(IF(shipment_id = 'S1', 1e10, 1) AS DECIMAL(20,2)) AS freight_cost_usd")
    assert broken(check_domain(frame, SHIPMENTS)) == {
        ("FLAG_0_1", "on_time_flag"): 1,
        ("MAX_LENGTH", "shipment_status"): 1,
        ("DECIMAL_RANGE", "freight_cost_usd"): 1,
    }


def test_unique(spark):
    frame = shipments(spark, shipment(1), shipment(1), shipment(1), shipment(2))
    row = check_unique(frame, "t", ["shipment_id", "order_id"]).first()
    assert tuple(row) == ("t", "shipment_id+order_id", 4, 1, 2)
    assert tuple(check_unique(frame.filter("false"), "t", ["order_id"]).first())[2:] == (0, 0, 0)


def test_references_count_orphans_and_null_keys(spark):
    frame = shipments(
        spark, shipment(1), shipment(2, carrier_id="C8"), shipment(3, carrier_id="C8"),
        shipment(4, carrier_id=None), shipment(5, supplier_id="P9", carrier_id="C8"),
    )
    references = {
        "carrier_id": (spark.sql("SELECT * FROM VALUES ('C1'), ('C1') AS t(carrier_id)"), "carrier_id"),
        "supplier_id": (spark.sql("SELECT 'P1' AS supplier_id"), "supplier_id"),
        "destination_warehouse_id": (spark.sql("SELECT 'W1' AS warehouse_id"), "warehouse_id"),
    }
    assert values(check_references(frame, references, "t")) == [
        ("t.carrier_id", 2, 4), ("t.destination_warehouse_id", 0, 0), ("t.supplier_id", 1, 1),
    ]
    empty = check_references(frame.filter("false"), references, "t")
    assert {tuple(r)[1:] for r in empty.collect()} == {(0, 0)}
    one = {"carrier_id": references["carrier_id"]}
    assert values(check_references(frame, one, "t")) == [("t.carrier_id", 2, 4)]


def test_access_unions_a_users_grants(spark):
    suppliers = spark.sql(
        "SELECT * FROM VALUES ('P1', 'a'), ('P2', 'b'), ('P3', 'c') AS t(supplier_id, category)"
    )
    grants = spark.sql(
        "SELECT * FROM VALUES ('u', 'a'), ('u', 'a'), ('u', 'c'), ('v', 'b') "
        "AS t(user_name, category)"
    )
    allowed = permitted(suppliers, grants, "u", "category")
    assert values(allowed, "supplier_id") == [("P1",), ("P3",)]
    fact = shipments(spark, shipment(1), shipment(2, supplier_id="P2"), shipment(3))
    assert values(visible(fact, "supplier_id", allowed, "supplier_id"), "shipment_id") == [
        ("S1",), ("S3",),
    ]
    assert permitted(suppliers, grants, "nobody", "category").count() == 0
    assert fact.first().freight_cost_usd == Decimal("250.00")
