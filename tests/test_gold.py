from decimal import Decimal

import pytest
from helpers import SMALL, shipment, shipments, values
from pyspark.sql import functions as F

from freightmill.contracts import AGG_CARRIER_SCORECARD
from freightmill.operators.enrich import enrich_shipments
from freightmill.plans import gold, reports, summary, warehouse_queries
from freightmill.plans.calendar import with_date_columns
from freightmill.registry import Feeds


@pytest.fixture(scope="module")
def feeds(spark):
    return Feeds(spark, SMALL)


@pytest.fixture(scope="module")
def tables(feeds):
    fact = feeds.fact(destination=True)
    return {
        "carrier": gold.carrier_scorecard(fact, feeds.register()).collect(),
        "warehouse": gold.warehouse_monthly(fact, feeds.warehouses()).collect(),
        "supplier": gold.supplier_reliability(fact, feeds.suppliers()).collect(),
        "delays": gold.delay_breakdown(fact).collect(),
        "rows": feeds.trade.table("lineitem").count(),
    }


def test_every_shipment_is_in_each_gold_table(tables):
    assert sum(r.total_shipments for r in tables["carrier"]) == tables["rows"]
    assert sum(r.monthly_inbound_shipments for r in tables["warehouse"]) == tables["rows"]
    assert sum(r.total_orders for r in tables["supplier"]) == tables["rows"]


def test_freight_agrees_to_the_cent(tables):
    by_carrier = sum(r.total_freight_spend_usd for r in tables["carrier"])
    assert by_carrier == sum(r.monthly_freight_cost_usd for r in tables["warehouse"])
    assert isinstance(by_carrier, Decimal)


def test_percentages_are_their_count_ratios(tables):
    for r in tables["carrier"]:
        hundredths = (2 * r.on_time_shipments * 10000 + r.total_shipments) // (
            2 * r.total_shipments
        )
        assert r.actual_on_time_pct == Decimal(hundredths) / 100
        assert r.otif_shipments <= min(r.on_time_shipments, r.in_full_shipments)
        assert r.sla_breach_flag == int(r.actual_on_time_pct < r.sla_target_pct)


def test_delays_are_the_late_shipments(tables):
    late = tables["rows"] - sum(r.on_time_shipments for r in tables["carrier"])
    assert sum(r["count"] for r in tables["delays"]) == late
    assert "None" not in {r.reason for r in tables["delays"]}


def test_one_row_per_warehouse_and_month(tables):
    keys = [(r.warehouse_id, r.delivery_month) for r in tables["warehouse"]]
    assert len(keys) == len(set(keys))


def test_aggregate_table_has_its_contract(spark, feeds):
    sheet = gold.agg_carrier_scorecard(gold.carrier_scorecard(feeds.fact(), feeds.register()))
    assert sheet.columns == [*AGG_CARRIER_SCORECARD.columns, "updated_at"]
    for attribute in AGG_CARRIER_SCORECARD.attributes:
        assert sheet.schema[attribute.name].dataType == attribute.dtype
    assert sheet.count() == 8


def test_orphans_drop_out_of_inner_joined_tables(spark):
    fact = enrich_shipments(shipments(spark, shipment(1), shipment(2, carrier_id="C9")))
    carriers = spark.sql(
        "SELECT 'C1' AS carrier_id, 'n' AS carrier_name, 'm' AS transport_mode, "
        "CAST(100 AS DECIMAL(5,2)) AS sla_target_pct"
    )
    assert values(gold.carrier_scorecard(fact, carriers), "carrier_id", "sla_breach_flag") == [
        ("C1", 0)
    ]


def suppliers(spark, *ids):
    rows = ", ".join(f"('{i}')" for i in ids)
    return spark.sql(
        "SELECT supplier_id, concat('n', supplier_id) AS supplier_name, 'cat' AS category, "
        "'land' AS country, 3 AS agreed_lead_days, CAST(4 AS DECIMAL(4,2)) AS reliability_rating, "
        f"'Medium Risk' AS risk_profile FROM VALUES {rows} AS t(supplier_id)"
    )


def test_risk_matrix_needs_ten_orders(spark):
    rows = [shipment(i, supplier_id="P1") for i in range(10)]
    rows += [shipment(100 + i, supplier_id="P2", damage_reported_flag=1) for i in range(9)]
    fact = enrich_shipments(shipments(spark, *rows))
    matrix = warehouse_queries.supplier_risk_matrix(fact, suppliers(spark, "P1", "P2"))
    assert values(matrix, "supplier_id", "order_count") == [("P1", 10)]


def test_top_suppliers_break_ties_by_id(spark):
    fact = enrich_shipments(
        shipments(spark, *[shipment(i, supplier_id=f"P{i % 4}") for i in range(8)])
    )
    reliability = gold.supplier_reliability(fact, suppliers(spark, "P0", "P1", "P2", "P3"))
    assert [r[0] for r in values(summary.top_suppliers(reliability, 3), "supplier_id")] == [
        "P0", "P1", "P2",
    ]


def test_rank_leaves_gaps_on_ties(spark):
    rows = []
    for carrier, misses in (("C1", 0), ("C2", 0), ("C3", 1)):
        rows += [
            shipment(f"{carrier}{i}", carrier_id=carrier, on_time_flag=int(i >= misses))
            for i in range(4)
        ]
    carriers = spark.sql(
        "SELECT *, 'n' AS carrier_name, 'Road' AS transport_mode, 't' AS carrier_tier, "
        "CAST(80 AS DECIMAL(5,2)) AS sla_target_pct FROM VALUES ('C1'), ('C2'), ('C3') "
        "AS t(carrier_id)"
    )
    ranking = warehouse_queries.carrier_sla_ranking(
        enrich_shipments(shipments(spark, *rows)), carriers
    )
    assert values(ranking, "carrier_id", "mode_rank", "sla_status") == [
        ("C1", 1, "COMPLIANT"), ("C2", 1, "COMPLIANT"), ("C3", 3, "BREACH"),
    ]


def test_mean_of_ratios_is_not_the_ratio_of_sums(spark):
    fact = enrich_shipments(
        shipments(
            spark,
            shipment(1, weight_kg=Decimal("10"), freight_cost_usd=Decimal("100")),
            shipment(2, weight_kg=Decimal("1000"), freight_cost_usd=Decimal("100")),
            shipment(3, weight_kg=Decimal("0"), freight_cost_usd=Decimal("100")),
        )
    )
    row = warehouse_queries.exec_kpi_summary(fact).first()
    assert row.avg_freight_cost_per_kg == Decimal("5.0500")


def test_yearly_and_daily_growth(feeds):
    fact, calendar = feeds.fact(), feeds.dim_date()
    yearly = reports.freight_yoy_yearly(fact, calendar).collect()
    assert yearly[0].prior_freight_usd is None and yearly[0].yoy_growth is None
    for now, before in zip(yearly[1:], yearly):
        assert now.prior_freight_usd == before.freight_usd
    daily = {r.full_date: r for r in reports.freight_yoy_daily(fact).collect()}
    assert sum(r.freight_usd for r in daily.values()) == sum(r.freight_usd for r in yearly)
    for day, row in daily.items():
        before = day.replace(year=day.year - 1, day=28 if (day.month, day.day) == (2, 29) else day.day)
        expected = daily[before].freight_usd if before in daily else None
        assert row.prior_freight_usd == expected


def test_calendar_covers_whole_years(feeds):
    row = feeds.dim_date().agg(
        F.min("full_date"), F.max("full_date"), F.count("*"), F.countDistinct("date_key")
    ).first()
    assert [str(v) for v in row] == ["1995-01-01", "2001-12-31", "2557", "2557"]


def test_reports_are_the_same_with_a_stored_calendar(spark):
    feeds = Feeds(spark, SMALL)
    gap = F.expr("CASE WHEN quantity_units % 7 <> 0 THEN {0} END".format("actual_delivery_date"))
    fact = feeds.fact().withColumn("actual_delivery_date", gap)
    calendar = feeds.dim_date()
    for report in (
        reports.monthly_delivery_trend, reports.order_intake_monthly, reports.freight_yoy,
        reports.freight_yoy_yearly,
    ):
        rows = values(report(fact))
        assert rows == values(report(fact, calendar)) and rows
    days = calendar.select("full_date")
    assert values(with_date_columns(days)) == values(calendar)
    assert with_date_columns(days).dtypes == calendar.dtypes
