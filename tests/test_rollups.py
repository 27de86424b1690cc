"""Measures answered from stored totals instead of the fact."""

import pytest
from helpers import SMALL, plan_text, values
from pyspark.sql import functions as F

from freightmill.operators.day_tally import day_tally
from freightmill.operators.measures import evaluate
from freightmill.plans.model import FACT, above, between, equal_to, logistics_model, shipment_rollup
from freightmill.registry import Feeds

SHIPMENT_MEASURES = [
    "total_shipments", "total_freight_spend_usd", "total_weight_kg", "freight_cost_per_kg_weighted",
    "avg_transit_days", "avg_transit_delay_days", "on_time_shipments", "in_full_shipments",
    "otif_shipments", "damaged_shipments", "on_time_rate", "otif_rate", "damage_rate",
    "target_sla", "sla_variance", "sla_breach_status",
]


@pytest.fixture(scope="module")
def models(spark, tmp_path_factory):
    """(on the fact, with stored totals beside it); some transit days are unknown."""
    feeds = Feeds(spark, SMALL)
    fact = feeds.fact(destination=True).withColumn(
        "transit_days", F.expr("CASE WHEN quantity_units % 7 <> 0 THEN transit_days END")
    )
    folder = str(tmp_path_factory.mktemp("rollup") / "measure")
    day_tally(fact, "measure").write.partitionBy("order_day").parquet(folder)
    model = logistics_model(
        **{
            FACT: fact, "dim_carrier": feeds.register(), "dim_date": feeds.dim_date(),
            "dim_warehouse": feeds.warehouses(),
        }
    )
    return model, model.with_rollup(shipment_rollup(spark.read.parquet(folder)))


COVERED = [
    ((), {}),
    (("dim_carrier.transport_mode",), {}),
    (("dim_carrier.carrier_id", "dim_date.year_num"), {}),
    ((f"{FACT}.on_time_flag",), {"dim_carrier.carrier_tier": equal_to("Tier-2 Standard")}),
    (("dim_carrier.carrier_id",), {f"{FACT}.on_time_flag": equal_to(0)}),
    (("dim_date.month_num",), {"dim_date.year_num": between(1996, 1997), f"{FACT}.in_full_flag": equal_to(1)}),
]


@pytest.mark.parametrize("by, context", COVERED)
def test_the_same_values_without_the_fact(models, by, context):
    on_fact, rolled = models
    want = evaluate(on_fact, SHIPMENT_MEASURES, by, context)
    got = evaluate(rolled, SHIPMENT_MEASURES, by, context)
    assert got.dtypes == want.dtypes
    assert values(got) == values(want) and values(want)
    assert "lineitem.parquet" in plan_text(want)
    assert "lineitem.parquet" not in plan_text(got)


def test_order_days_and_growth_without_the_fact(models):
    on_fact, rolled = (m.use_relationship("dim_date", "order_date") for m in models)
    for by in (("dim_date.year_num",), ("dim_date.full_date",)):
        want = evaluate(on_fact, ["freight_yoy_growth", "total_shipments"], by)
        got = evaluate(rolled, ["freight_yoy_growth", "total_shipments"], by)
        assert values(got) == values(want) and values(want)
        assert "lineitem.parquet" not in plan_text(got)


def test_no_rows_at_all(models):
    on_fact, rolled = models
    nothing = {"dim_carrier.carrier_id": equal_to("none")}
    measures = ["total_shipments", "total_weight_kg", "on_time_rate"]
    assert values(evaluate(rolled, measures, (), nothing)) == values(
        evaluate(on_fact, measures, (), nothing)
    )


@pytest.mark.parametrize(
    "measures, by, context",
    [
        (["total_shipments"], ("dim_warehouse.region",), {}),
        (["total_shipments"], (f"{FACT}.delay_reason",), {}),
        (["total_shipments"], (), {f"{FACT}.weight_kg": above(100)}),
    ],
)
def test_the_fact_answers_what_the_totals_do_not_cover(models, measures, by, context):
    on_fact, rolled = models
    got = evaluate(rolled, measures, by, context)
    assert "lineitem.parquet" in plan_text(got)
    assert values(got) == values(evaluate(on_fact, measures, by, context))


def test_security_reaches_the_totals(models):
    on_fact, rolled = models
    allowed = on_fact.tables["dim_carrier"].where("carrier_id IN ('CAR-1', 'CAR-2')")
    secured = [m.restrict("dim_carrier", allowed) for m in models]
    want, got = (values(evaluate(m, ["total_shipments"])) for m in secured)
    assert got == want != values(evaluate(on_fact, ["total_shipments"]))
