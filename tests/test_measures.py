from datetime import date, datetime
from decimal import Decimal

import pytest
from helpers import SMALL, plan_text, shipment, shipments, values

from freightmill.operators.access import permitted
from freightmill.operators.enrich import enrich_shipments
from freightmill.operators.measures import evaluate
from freightmill.plans import reports
from freightmill.plans.calendar import dim_date
from freightmill.plans.model import FACT, FLEET, above, equal_to, logistics_model, one_of
from freightmill.registry import Feeds


@pytest.fixture(scope="module")
def model(spark):
    fact = enrich_shipments(
        shipments(
            spark,
            shipment(1, carrier_id="C1"),
            shipment(2, carrier_id="C1", on_time_flag=0, delay_reason="Customs Hold"),
            shipment(3, carrier_id="C2", destination_warehouse_id="W2", in_full_flag=0,
                     damage_reported_flag=1, transit_days=9),
            shipment(4, carrier_id="C2", destination_warehouse_id="W2", on_time_flag=0,
                     actual_delivery_date=date(2024, 4, 2), weight_kg=Decimal("300.00")),
            shipment(5, carrier_id="C1", order_date=datetime(2024, 2, 29, 23, 59, 59)),
            shipment(6, carrier_id="C9"),
        )
    )
    carriers = spark.sql(
        "SELECT * FROM VALUES ('C1', 'Road', CAST(90 AS DECIMAL(5,2))), "
        "('C2', 'Road', CAST(40 AS DECIMAL(5,2))), ('C3', 'Sea', CAST(50 AS DECIMAL(5,2))) "
        "AS t(carrier_id, transport_mode, sla_target_pct)"
    )
    warehouses = spark.sql(
        "SELECT * FROM VALUES ('W1', 'North'), ('W2', 'South') AS t(warehouse_id, region)"
    )
    bounds = spark.sql("SELECT DATE'2024-01-01' AS first_day, DATE'2024-12-31' AS last_day")
    return logistics_model(
        **{
            FACT: fact,
            "dim_carrier": carriers,
            "dim_warehouse": warehouses,
            "dim_date": dim_date(bounds),
        }
    )


def test_own_filter_replaces_the_context_filter(model):
    late = {f"{FACT}.on_time_flag": equal_to(0)}
    row = evaluate(model, ["total_shipments", "on_time_shipments", "in_full_shipments"],
                   context=late).first()
    assert tuple(row) == (2, 4, 2)


def test_other_context_filters_stay(model):
    context = {f"{FACT}.on_time_flag": equal_to(0), "dim_warehouse.region": equal_to("South")}
    row = evaluate(model, ["total_shipments", "on_time_shipments"], context=context).first()
    assert tuple(row) == (1, 1)


def test_empty_context_gives_zero_rates_and_null_means(model):
    nothing = {f"{FACT}.carrier_id": equal_to("nobody")}
    row = evaluate(
        model,
        ["total_shipments", "on_time_shipments", "on_time_rate", "freight_cost_per_kg_weighted",
         "avg_transit_days", "total_freight_spend_usd"],
        context=nothing,
    ).first()
    assert tuple(row) == (0, 0, 0.0, 0.0, None, None)


def test_weighted_cost_divides_sums(model):
    row = evaluate(model, ["freight_cost_per_kg_weighted"]).first()
    assert row[0] == pytest.approx(1500 / 800)


def test_target_is_a_mean_over_the_dimension(model):
    total = evaluate(model, ["target_sla", "on_time_rate"]).first()
    assert total[0] == pytest.approx(0.60)
    by_mode = values(evaluate(model, ["target_sla", "sla_breach_status"],
                              by=["dim_carrier.transport_mode"]))
    assert by_mode == [("Road", pytest.approx(0.65), "🚨 SLA Breached")]
    by_region = values(evaluate(model, ["target_sla"], by=["dim_warehouse.region"]))
    assert by_region == [("North", pytest.approx(0.60)), ("South", pytest.approx(0.60))]
    sea = {"dim_carrier.transport_mode": equal_to("Road"), "dim_carrier.carrier_id": equal_to("C2")}
    row = evaluate(model, ["target_sla", "sla_variance", "sla_breach_status"], context=sea).first()
    assert tuple(row) == (pytest.approx(0.4), pytest.approx(0.1), "✅ SLA Compliant")


def test_unrelated_members_are_only_dropped_by_a_used_dimension(model):
    assert evaluate(model, ["total_shipments"]).first()[0] == 6
    assert sum(r[1] for r in values(evaluate(model, ["total_shipments"],
                                             by=["dim_carrier.carrier_id"]))) == 5


def test_date_roles(model):
    by = ["dim_date.month_num"]
    assert values(evaluate(model, ["total_shipments"], by=by)) == [(3, 5), (4, 1)]
    ordered = model.use_relationship("dim_date", "order_date")
    assert values(evaluate(ordered, ["total_shipments"], by=by)) == [(2, 1), (3, 5)]


def test_two_dimensions_and_a_fact_column(model):
    rows = values(
        evaluate(model, ["total_shipments"],
                 by=["dim_carrier.transport_mode", "dim_warehouse.region", f"{FACT}.delay_reason"])
    )
    assert rows == [("Road", "North", "Customs Hold", 1), ("Road", "North", "None", 2),
                    ("Road", "South", "None", 2)]


def test_row_level_security_applies_without_being_asked_for(spark, model):
    grants = spark.sql("SELECT * FROM VALUES ('u', 'South') AS t(user_name, region)")
    allowed = permitted(model.tables["dim_warehouse"], grants, "u", "region")
    mine = model.restrict("dim_warehouse", allowed)
    assert evaluate(mine, ["total_shipments"]).first()[0] == 2
    nobody = model.restrict(
        "dim_warehouse", permitted(model.tables["dim_warehouse"], grants, "x", "region")
    )
    assert evaluate(nobody, ["total_shipments"]).first()[0] == 0


def test_telematics_measures(spark):
    fleet = spark.sql(
        "SELECT * FROM VALUES (5.0D, 0.0D, 1), (10.0D, 30.0D, 0), (20.0D, 40.0D, 1) "
        "AS t(speed_kmh, fuel_consumption_l_100km, maintenance_alert_flag)"
    )
    model = logistics_model(**{FLEET: fleet})
    names = ["avg_vehicle_speed_kmh", "avg_fuel_moving_l_100km", "active_maintenance_alerts"]
    assert tuple(evaluate(model, names).first()) == (pytest.approx(35 / 3), 35.0, 2)
    fast = {f"{FLEET}.speed_kmh": above(15)}
    assert tuple(evaluate(model, names, context=fast).first()) == (20.0, 35.0, 1)


def test_bad_requests(model):
    with pytest.raises(ValueError, match="differ in name"):
        evaluate(model, ["total_shipments"], by=["dim_carrier.carrier_id", f"{FACT}.carrier_id"])
    with pytest.raises(ValueError, match="exactly one fact"):
        evaluate(model, ["total_shipments", "avg_vehicle_speed_kmh"])
    with pytest.raises(ValueError, match="table.column"):
        evaluate(model, ["total_shipments"], by=["carrier_id"])


def test_shared_context_filter_is_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "fact")
    enrich_shipments(shipments(spark, shipment(1))).write.parquet(path)
    model = logistics_model(**{FACT: spark.read.parquet(path)})
    text = plan_text(
        evaluate(model, ["total_shipments", "on_time_shipments"],
                 context={f"{FACT}.carrier_id": one_of("C1", "C2")})
    )
    assert "In(carrier_id, [C1,C2])" in text
    assert "freight_cost_usd" not in text.split("ReadSchema:")[1].splitlines()[0]


def test_one_fact_pass(model):
    sheet = evaluate(model, ["total_shipments", "on_time_rate", "otif_rate", "avg_transit_days"],
                     by=["dim_carrier.transport_mode"])
    reads = sheet._jdf.queryExecution().optimizedPlan().collectLeaves().size()
    assert reads == 2  # the fact and the carriers


def test_growth_measure_equals_the_report(spark):
    feeds = Feeds(spark, SMALL)
    model = logistics_model(
        **{FACT: feeds.fact(), "dim_date": feeds.dim_date(), "dim_carrier": feeds.register()}
    )
    months = ["dim_date.year_num", "dim_date.month_num"]
    names = ["total_freight_spend_usd", "freight_yoy_growth"]
    got = {(r[0], r[1]): (r[2], r[3]) for r in evaluate(model, names, by=months).collect()}
    report = reports.freight_yoy(feeds.fact(), feeds.dim_date()).collect()
    assert set(got) == {(r.year_num, r.month_num) for r in report}
    for r in report:
        spend, growth = got[r.year_num, r.month_num]
        assert spend == r.freight_usd
        assert growth == (r.yoy_growth and pytest.approx(float(r.yoy_growth), abs=1e-6))

    later = evaluate(model, names, by=["dim_date.year_num"],
                     context={"dim_date.year_num": equal_to(1998)}).collect()
    yearly = {r.year_num: r for r in reports.freight_yoy_yearly(feeds.fact(), feeds.dim_date()).collect()}
    assert len(later) == 1
    assert later[0][2] == pytest.approx(float(yearly[1998].yoy_growth), abs=1e-6)

    daily = evaluate(model, ["freight_yoy_growth"],
                     by=["dim_date.full_date", "dim_carrier.transport_mode"])
    assert daily.filter("freight_yoy_growth IS NOT NULL").count() > 0


def test_growth_needs_whole_periods(model):
    for by, context in (
        (["dim_carrier.carrier_id"], {}),
        (["dim_date.year_num"], {"dim_date.month_num": equal_to(3)}),
        (["dim_date.full_date", "dim_date.month_num"], {}),
    ):
        with pytest.raises(ValueError, match="growth needs"):
            evaluate(model, ["freight_yoy_growth"], by=by, context=context)


def test_a_dimension_mean_needs_no_fact(model):
    assert evaluate(model, ["target_sla"]).first()[0] == pytest.approx(0.60)
    rows = values(evaluate(model, ["target_sla"], by=["dim_carrier.transport_mode"]))
    assert rows == [("Road", pytest.approx(0.65)), ("Sea", pytest.approx(0.50))]


def test_growth_reads_the_fact_once(model):
    sheet = evaluate(model, ["on_time_rate", "freight_yoy_growth"],
                     by=["dim_date.year_num", "dim_date.month_num"])
    assert sheet._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 2
