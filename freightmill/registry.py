"""Every query by name, each over a folder of trade tables.

All of them run on whole tables. The upsert, batch and surrogate queries build the
table they load into and the rows they load from the same feeds.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightmill.contracts import FEEDS, TELEMATICS
from freightmill.functions.labels import TIER_ECONOMY, TIER_STANDARD
from freightmill.functions.numeric import half_up
from freightmill.operators.batch_replace import fact_rows, replace_day
from freightmill.operators.day_tally import day_tally, on_days, over_days, replace_days
from freightmill.operators.enrich import (
    enrich_carriers,
    enrich_shipments,
    enrich_suppliers,
    enrich_warehouses,
    with_gate_status,
)
from freightmill.operators.measures import Model, evaluate
from freightmill.operators.quality import check_unique
from freightmill.operators.upsert import assign_surrogates, upsert
from freightmill.plans import (
    calendar,
    gold,
    quality_report,
    reports,
    secured,
    summary,
    warehouse_queries,
)
from freightmill.plans.model import FACT, FLEET, equal_to, logistics_model, shipment_rollup
from freightmill.sources.files import parse_json_text
from freightmill.sources.lake import stack
from freightmill.sources.trade_tables import (
    ORDER_ID,
    SHIPMENT_ID,
    SUPPLIER_CATEGORIES,
    TradeTables,
)

Query = Callable[[SparkSession, str], DataFrame]

BATCH_DATE = date(1995, 2, 18)
SLICER_FIRST, SLICER_LAST = date(1997, 1, 1), date(1998, 12, 31)

# Who may see what: user -> granted values.
REGION_GRANTS = [("amara", "EUROPE"), ("amara", "ASIA"), ("bashir", "AFRICA")]
CATEGORY_GRANTS = [
    ("chidi", "Raw Packaging"),
    ("chidi", "Industrial Sensors"),
    ("dora", "Automotive Parts"),
]


class Feeds:
    """Silver-level inputs of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.trade = TradeTables(spark, folder)

    def fact(self, destination: bool = False) -> DataFrame:
        return enrich_shipments(self.trade.shipments(destination))

    def register(self) -> DataFrame:
        """Carrier names, modes, targets and tiers, for joins to the fact."""
        return enrich_carriers(self.trade.carrier_register())

    def carriers(self) -> DataFrame:
        return enrich_carriers(self.trade.carriers())

    def warehouses(self) -> DataFrame:
        return enrich_warehouses(self.trade.warehouses())

    def suppliers(self) -> DataFrame:
        return enrich_suppliers(self.trade.suppliers())

    def dim_date(self) -> DataFrame:
        return calendar.dim_date(self.trade.calendar_bounds())

    def grants(self, rows: list[tuple[str, str]], attribute: str) -> DataFrame:
        values = ", ".join(f"('{user}', '{value}')" for user, value in rows)
        return self.spark.sql(f"SELECT * FROM VALUES {values} AS t(user_name, {attribute})")

    def carrier_model(self) -> Model:
        return logistics_model(**{FACT: self.fact(), "dim_carrier": self.register()})


QUERIES: dict[str, Query] = {}


def query(build: Callable[[Feeds], DataFrame]) -> Callable[[Feeds], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Feeds(spark, folder))
    return build


# -- bronze and silver -------------------------------------------------------


@query
def bronze_source_tag(f: Feeds) -> DataFrame:
    feeds = {
        "shipments": (f.trade.shipments(), "shipment_id"),
        "carriers": (f.trade.carriers(), "carrier_id"),
        "warehouses": (f.trade.warehouses(), "warehouse_id"),
        "suppliers": (f.trade.suppliers(), "supplier_id"),
        "fleet_telematics": (f.trade.telematics(), "telematics_id"),
    }
    return stack(
        [
            feed.select(
                F.lit(name).alias("feed"),
                F.col(key).cast("string").alias("record_id"),
                F.lit(FEEDS[name].source_system).alias("_source_system"),
            )
            for name, (feed, key) in feeds.items()
        ]
    )


@query
def bronze_json_records(f: Feeds) -> DataFrame:
    """Telematics as JSON lines, some of them followed by text, naming a field twice, no
    object, or cut short: read digit by digit or refused whole."""
    feed = parse_json_text(f.trade.telematics_lines(), TELEMATICS)
    refused = F.col("_corrupt_record")
    return feed.select(
        "event_id",
        F.when(refused.isNull(), "ACCEPTED").otherwise("QUARANTINED").alias("status"),
        "vehicle_id",
        F.col("speed_kmh").alias("speed_text"),
        F.col("_extra")["note"].alias("note"),
        F.col("_flaw").alias("flaw"),
        F.length(refused).alias("refused_length"),
    )


@query
def silver_not_null_gate(f: Feeds) -> DataFrame:
    # The trade tables have no NULL keys; an order id is lost on some parts' lines.
    lines = f.trade.table("lineitem").selectExpr(
        f"{SHIPMENT_ID} AS shipment_id",
        f"CASE WHEN pmod(l_partkey, 50) <> 0 THEN {ORDER_ID} END AS order_id",
        "l_suppkey AS supplier_id",
    )
    return with_gate_status(lines)


@query
def silver_shipments(f: Feeds) -> DataFrame:
    return f.fact(destination=True).drop(
        "order_date_dt", "promised_delivery_dt", "actual_delivery_dt", "shipment_hash_key"
    )


@query
def silver_shipment_hash(f: Feeds) -> DataFrame:
    return f.fact().select("shipment_id", "shipment_hash_key")


@query
def silver_carrier_tier(f: Feeds) -> DataFrame:
    return f.carriers()


@query
def silver_warehouse_cost(f: Feeds) -> DataFrame:
    return f.warehouses()


@query
def silver_supplier_risk(f: Feeds) -> DataFrame:
    return f.suppliers()


# -- gold --------------------------------------------------------------------


@query
def gold_carrier_scorecard(f: Feeds) -> DataFrame:
    return gold.with_breach_badge(gold.carrier_scorecard(f.fact(), f.register()))


@query
def gold_carrier_scorecard_gaps(f: Feeds) -> DataFrame:
    """Transit days are unknown for some quantities: means are over the known ones."""
    gap = "CASE WHEN quantity_units % 7 <> 0 THEN {0} END"
    fact = f.fact().withColumns(
        {c: F.expr(gap.format(c)) for c in ("transit_days", "transit_delay_days")}
    )
    return gold.with_breach_badge(gold.carrier_scorecard(fact, f.register()))


@query
def gold_scorecard_by_days(f: Feeds) -> DataFrame:
    """Two landings: all shipments, then the days of one month again with freight raised by
    1 USD and a register that renames CAR-1..4 and no longer lists the others."""
    fact = f.fact()
    days = [date(1995, 2, d) for d in range(1, 29)]
    again = fact.filter(on_days(fact, days)).withColumn(
        "freight_cost_usd", (F.col("freight_cost_usd") + 1).cast("decimal(12,2)")
    )
    totals = replace_days(day_tally(fact, "carrier"), day_tally(again, "carrier"), days)
    register = f.register()
    listed = register.filter(_code("carrier_id") <= 4).withColumn(
        "carrier_name", F.concat("carrier_name", F.lit(" Group"))
    )
    kept = upsert(register, listed, "carrier_id", register.columns)
    return gold.carrier_sheet(over_days(totals, "carrier_id"), kept)


@query
def gold_warehouse_monthly(f: Feeds) -> DataFrame:
    return gold.warehouse_monthly(f.fact(destination=True), f.warehouses())


@query
def warehouse_month_trunc(f: Feeds) -> DataFrame:
    return gold.warehouse_monthly_by_date(f.fact(destination=True), f.warehouses())


@query
def gold_supplier_reliability(f: Feeds) -> DataFrame:
    return gold.supplier_reliability(f.fact(), f.suppliers())


@query
def delay_breakdown(f: Feeds) -> DataFrame:
    return gold.delay_breakdown(f.fact())


@query
def delay_breakdown_pct(f: Feeds) -> DataFrame:
    return gold.delay_breakdown_pct(f.fact())


# -- warehouse queries -------------------------------------------------------


@query
def exec_kpi_summary(f: Feeds) -> DataFrame:
    return warehouse_queries.exec_kpi_summary(f.fact())


@query
def carrier_sla_ranking(f: Feeds) -> DataFrame:
    return warehouse_queries.carrier_sla_ranking(f.fact(), f.register())


@query
def warehouse_efficiency(f: Feeds) -> DataFrame:
    return warehouse_queries.warehouse_efficiency(f.fact(destination=True), f.warehouses())


@query
def supplier_risk_matrix(f: Feeds) -> DataFrame:
    return warehouse_queries.supplier_risk_matrix(f.fact(), f.suppliers())


# -- loads -------------------------------------------------------------------


@query
def dim_date(f: Feeds) -> DataFrame:
    return f.dim_date()


def _code(column: str):
    return F.substring_index(column, "-", -1).cast("int")


@query
def dim_carrier_merge(f: Feeds) -> DataFrame:
    """CAR-1..5 are in the table, CAR-3..8 arrive under new names."""
    carriers = f.carriers()
    target = carriers.filter(_code("carrier_id") <= 5).withColumn("is_active", F.lit(1))
    source = carriers.filter(_code("carrier_id") >= 3).withColumn(
        "carrier_name", F.concat("carrier_name", F.lit(" Group"))
    )
    return upsert(target, source, "carrier_id", carriers.columns, {"is_active": F.lit(1)})


@query
def dim_warehouse_merge(f: Feeds) -> DataFrame:
    """Two overlapping halves of the key range; the second has grown."""
    warehouses = f.warehouses()
    target = warehouses.filter(F.col("warehouse_id") < 15)
    source = warehouses.filter(F.col("warehouse_id") >= 10).withColumn(
        "capacity_sqft", F.col("capacity_sqft") + 1000
    )
    return upsert(target, source, "warehouse_id", warehouses.columns)


@query
def dim_supplier_merge(f: Feeds) -> DataFrame:
    """Suppliers of the first three categories are in the table; the last four categories
    arrive with longer lead times, so one category overlaps."""
    suppliers = f.suppliers()
    category = F.col("category")
    target = suppliers.filter(category.isin(SUPPLIER_CATEGORIES[:3]))
    source = suppliers.filter(category.isin(SUPPLIER_CATEGORIES[2:])).withColumn(
        "agreed_lead_days", F.col("agreed_lead_days") + 1
    )
    return upsert(target, source, "supplier_id", suppliers.columns)


@query
def dim_carrier_surrogate(f: Feeds) -> DataFrame:
    """CAR-1..5 keep their keys, the rest are numbered on from the highest."""
    code = _code("carrier_id")
    keyed = f.carriers().select(
        "carrier_id", "carrier_name", F.when(code <= 5, code).alias("carrier_key")
    )
    return assign_surrogates(keyed, "carrier_id", "carrier_key")


@query
def fact_load_batch(f: Feeds) -> DataFrame:
    """One order day is delivered again with every freight cost raised by 1 USD."""
    fact = f.fact(destination=True)
    restated = fact.withColumn(
        "freight_cost_usd", (F.col("freight_cost_usd") + 1).cast("decimal(12,2)")
    )
    return replace_day(fact_rows(fact), restated, BATCH_DATE)


@query
def fact_load_batch_changed(f: Feeds) -> DataFrame:
    """The day comes again without some shipments, with other costs, and with the next day's
    shipments moved to it."""
    fact = f.fact(destination=True)
    day = F.col("order_date").cast("date")
    kept = fact.filter((day == F.lit(BATCH_DATE)) & (F.col("quantity_units") % 5 != 0))
    kept = kept.withColumn(
        "freight_cost_usd", (F.col("freight_cost_usd") + 1).cast("decimal(12,2)")
    )
    moved = fact.filter(day == F.date_add(F.lit(BATCH_DATE), 1))
    moved = moved.withColumn("shipment_id", F.concat("shipment_id", F.lit("-M"))).withColumn(
        "order_date", F.expr("order_date - INTERVAL 1 DAY")
    )
    return replace_day(fact_rows(fact), kept.unionByName(moved), BATCH_DATE)


# -- measures ----------------------------------------------------------------


def _rounded(sheet: DataFrame, *columns: str) -> DataFrame:
    return sheet.withColumns({c: half_up(F.col(c), 6) for c in columns})


def _shipment_measures(model: Model) -> DataFrame:
    sheet = evaluate(
        model,
        [
            "total_shipments",
            "total_freight_spend_usd",
            "total_weight_kg",
            "freight_cost_per_kg_weighted",
            "avg_transit_days",
            "avg_transit_delay_days",
        ],
        by=["dim_carrier.transport_mode"],
    )
    return _rounded(
        sheet, "freight_cost_per_kg_weighted", "avg_transit_days", "avg_transit_delay_days"
    )


@query
def measures_shipment(f: Feeds) -> DataFrame:
    return _shipment_measures(f.carrier_model())


@query
def measures_shipment_rollup(f: Feeds) -> DataFrame:
    """The measures again, answered from totals by day, carrier and flags."""
    totals = day_tally(f.fact(), "measure")
    return _shipment_measures(f.carrier_model().with_rollup(shipment_rollup(totals)))


@query
def measures_otif(f: Feeds) -> DataFrame:
    sheet = evaluate(
        f.carrier_model(),
        [
            "on_time_shipments",
            "in_full_shipments",
            "otif_shipments",
            "on_time_rate",
            "otif_rate",
            "damage_rate",
        ],
        by=["dim_carrier.carrier_id"],
    )
    return _rounded(sheet, "on_time_rate", "otif_rate", "damage_rate")


@query
def measures_sla(f: Feeds) -> DataFrame:
    sheet = evaluate(
        f.carrier_model(),
        ["on_time_rate", "target_sla", "sla_variance", "sla_breach_status"],
        by=["dim_carrier.transport_mode"],
    )
    return _rounded(sheet, "on_time_rate", "target_sla", "sla_variance")


@query
def measure_calculate_override(f: Feeds) -> DataFrame:
    """Under "late shipments only", the on-time count still counts on-time shipments."""
    return evaluate(
        f.carrier_model(),
        ["total_shipments", "on_time_shipments", "in_full_shipments"],
        by=["dim_carrier.carrier_id"],
        context={f"{FACT}.on_time_flag": equal_to(0)},
    )


@query
def telematics_kpis(f: Feeds) -> DataFrame:
    sheet = evaluate(
        logistics_model(**{FLEET: f.trade.telematics()}),
        ["avg_vehicle_speed_kmh", "avg_fuel_moving_l_100km", "active_maintenance_alerts"],
    )
    return sheet.withColumns(
        {
            c: half_up(F.col(c), 4)
            for c in ("avg_vehicle_speed_kmh", "avg_fuel_moving_l_100km")
        }
    )


@query
def freight_yoy(f: Feeds) -> DataFrame:
    return reports.freight_yoy(f.fact())


# -- reports -----------------------------------------------------------------


@query
def monthly_delivery_trend(f: Feeds) -> DataFrame:
    return reports.monthly_delivery_trend(f.fact())


@query
def order_intake_monthly(f: Feeds) -> DataFrame:
    return reports.order_intake_monthly(f.fact())


@query
def report_top5_carriers(f: Feeds) -> DataFrame:
    return reports.top_carriers(warehouse_queries.carrier_sla_ranking(f.fact(), f.register()))


@query
def report_region_matrix(f: Feeds) -> DataFrame:
    return reports.region_matrix(f.fact(destination=True), f.warehouses())


@query
def report_cost_otif_scatter(f: Feeds) -> DataFrame:
    return reports.cost_otif_scatter(f.carrier_model())


@query
def report_mode_variance(f: Feeds) -> DataFrame:
    return reports.mode_variance(f.fact(), f.register())


@query
def report_slicer(f: Feeds) -> DataFrame:
    return reports.slicer_sheet(
        f.carrier_model(),
        tiers=[TIER_STANDARD, TIER_ECONOMY],
        modes=["Road", "Sea", "Sea/Air"],
        first=SLICER_FIRST,
        last=SLICER_LAST,
    )


@query
def report_delay_decomposition(f: Feeds) -> DataFrame:
    return reports.delay_decomposition(f.fact(), f.suppliers())


@query
def report_top10_risk_suppliers(f: Feeds) -> DataFrame:
    return reports.top_risk_suppliers(gold.supplier_reliability(f.fact(), f.suppliers()))


# -- summary document --------------------------------------------------------


@query
def summary_kpis(f: Feeds) -> DataFrame:
    return summary.summary_kpis(f.fact(), f.suppliers(), f.warehouses())


@query
def summary_top_suppliers(f: Feeds) -> DataFrame:
    return summary.top_suppliers(gold.supplier_reliability(f.fact(), f.suppliers()))


@query
def carrier_top_volume(f: Feeds) -> DataFrame:
    scorecard = gold.carrier_scorecard(f.fact(), f.register())
    return summary.carriers_by_volume(scorecard, summary.TOP_CARRIERS).select(
        "carrier_id", "carrier_name", "transport_mode", "total_shipments",
        "sla_target_pct", "actual_otif_pct", "otif_target_status",
    )


@query
def warehouse_otif_status(f: Feeds) -> DataFrame:
    return summary.warehouse_status(
        gold.warehouse_monthly(f.fact(destination=True), f.warehouses())
    )


@query
def supplier_damage_status(f: Feeds) -> DataFrame:
    return summary.supplier_damage(
        gold.supplier_reliability(f.fact(), f.suppliers())
    ).select("supplier_id", "supplier_name", "damage_rate_pct", "damage_status")


# -- access ------------------------------------------------------------------


@query
def rls_region_manager(f: Feeds) -> DataFrame:
    return secured.regional_manager_view(
        f.fact(destination=True), f.warehouses(), f.grants(REGION_GRANTS, "region"), "amara"
    )


@query
def rls_supplier_manager(f: Feeds) -> DataFrame:
    return secured.supplier_manager_view(
        f.fact(), f.suppliers(), f.grants(CATEGORY_GRANTS, "category"), "chidi"
    )


# -- quality -----------------------------------------------------------------


def _checked_tables(f: Feeds) -> dict[str, DataFrame]:
    return {
        "shipments": f.fact(destination=True),
        "carriers": f.carriers(),
        "warehouses": f.warehouses(),
        "suppliers": f.suppliers(),
    }


@query
def dq_not_null(f: Feeds) -> DataFrame:
    return quality_report.not_null_report(_checked_tables(f))


@query
def dq_domain(f: Feeds) -> DataFrame:
    return quality_report.domain_report(_checked_tables(f))


def _planted(f: Feeds) -> dict[str, DataFrame]:
    """Shipments with faults by quantity: lost ids, odd flags, long status, raw number text."""
    faults = {
        "carrier_id": "CASE WHEN quantity_units % 17 <> 0 THEN carrier_id END",
        "on_time_flag": "CASE WHEN quantity_units % 11 = 0 THEN 2 ELSE on_time_flag END",
        "shipment_status": "CASE WHEN quantity_units % 13 = 0 THEN repeat(shipment_status, 9) "
        "ELSE shipment_status END",
        "weight_kg": "CASE WHEN quantity_units % 7 = 0 THEN concat(weight_kg, '5') "
        "WHEN quantity_units % 5 = 0 THEN concat('9999999', weight_kg) "
        "WHEN quantity_units % 3 = 0 THEN 'heavy' ELSE CAST(weight_kg AS STRING) END",
    }
    fact = f.fact()
    known = [faults.get(c, c) + f" AS {c}" for c in fact.columns]
    return {"shipments": fact.selectExpr(*known)}


@query
def dq_not_null_planted(f: Feeds) -> DataFrame:
    return quality_report.not_null_report(_planted(f)).filter(
        F.col("column_name").isin("carrier_id", "order_id")
    )


@query
def dq_domain_planted(f: Feeds) -> DataFrame:
    checked = ["on_time_flag", "in_full_flag", "shipment_status", "weight_kg"]
    return quality_report.domain_report(_planted(f)).filter(F.col("column_name").isin(checked))


@query
def dq_unique(f: Feeds) -> DataFrame:
    """Business keys, and the order line number that the trade tables do repeat."""
    lines = f.trade.table("lineitem")
    return quality_report.unique_report(_checked_tables(f)).unionByName(
        check_unique(lines, "lineitem", ["l_orderkey", "l_linenumber"])
    )


@query
def dq_orphans(f: Feeds) -> DataFrame:
    """References, with one region's warehouses missing from the dimension."""
    tables = _checked_tables(f)
    tables["warehouses"] = tables["warehouses"].filter(F.col("region") != "AFRICA")
    return quality_report.orphan_report(tables)
