"""Datasets behind the report pages."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightmill.functions.labels import OTIF_TREND_TARGET_PCT, is_delayed
from freightmill.functions.numeric import half_up, ratio
from freightmill.functions.temporal import month_label, month_start
from freightmill.operators.measures import Model, evaluate
from freightmill.operators.prior_period import with_prior_year, with_prior_year_daily
from freightmill.operators.tally import merge_tallies, pct_of_shipments, tally
from freightmill.plans.calendar import with_date_columns
from freightmill.plans.model import FACT, between, one_of

TOP_CARRIERS = 5
TOP_RISK_SUPPLIERS = 10


# -- time ------------------------------------------------------------------


def _by_month(fact: DataFrame, day: Column, dim_date: DataFrame | None) -> DataFrame:
    """Monthly totals through the date dimension, the fact grouped by day beforehand.

    Without a stored dimension its columns are taken from the days the totals hold, so that
    nothing is read besides the fact. Shipments without the day are in no month.
    """
    daily = tally(fact, day.alias("full_date"))
    if dim_date is None:
        daily = with_date_columns(daily.filter(F.col("full_date").isNotNull()))
    else:
        calendar = dim_date.select("full_date", "year_num", "month_num")
        daily = daily.join(calendar, "full_date")
    return merge_tallies(daily, "year_num", "month_num")


def _month_text() -> Column:
    return F.format_string("%04d-%02d", F.col("year_num"), F.col("month_num"))


def monthly_delivery_trend(fact: DataFrame, dim_date: DataFrame | None = None) -> DataFrame:
    """Volume and on-time-in-full rate by month of delivery, with the target line."""
    months = _by_month(fact, F.col("actual_delivery_date"), dim_date)
    return months.select(
        _month_text().alias("delivery_month"),
        F.col("shipments").alias("total_shipments"),
        pct_of_shipments("otif").alias("otif_pct"),
        F.lit(OTIF_TREND_TARGET_PCT).alias("target_pct"),
    ).orderBy("delivery_month")


def order_intake_monthly(fact: DataFrame, dim_date: DataFrame | None = None) -> DataFrame:
    """The same fact by month of order: the date dimension in its second role."""
    months = _by_month(fact, F.col("order_date").cast("date"), dim_date)
    return months.select(
        _month_text().alias("order_month"),
        F.col("shipments").alias("shipments_ordered"),
        F.col("weight").alias("ordered_weight_kg"),
        F.col("freight").alias("ordered_freight_usd"),
    ).orderBy("order_month")


def _growth(frame: DataFrame, keys: list[str]) -> DataFrame:
    now, then = F.col("freight_usd"), F.col("prior_freight_usd")
    return frame.select(
        *keys, now, then, half_up(ratio(now - then, then), 6).alias("yoy_growth")
    ).orderBy(*keys)


def freight_yoy(fact: DataFrame, dim_date: DataFrame | None = None) -> DataFrame:
    """Freight against the same month of the year before; no such month, no growth."""
    months = _by_month(fact, F.col("actual_delivery_date"), dim_date).select(
        "year_num", "month_num", F.col("freight").alias("freight_usd")
    )
    compared = with_prior_year(months, "year_num", ["month_num"], "freight_usd")
    return _growth(compared, ["year_num", "month_num"])


def freight_yoy_yearly(fact: DataFrame, dim_date: DataFrame | None = None) -> DataFrame:
    months = _by_month(fact, F.col("actual_delivery_date"), dim_date)
    years = merge_tallies(months, "year_num").select(
        "year_num", F.col("freight").alias("freight_usd")
    )
    return _growth(with_prior_year(years, "year_num", [], "freight_usd"), ["year_num"])


def freight_yoy_daily(fact: DataFrame) -> DataFrame:
    days = tally(fact, F.col("actual_delivery_date").alias("full_date")).select(
        "full_date", F.col("freight").alias("freight_usd")
    )
    return _growth(with_prior_year_daily(days, "full_date", [], "freight_usd"), ["full_date"])


# -- carriers --------------------------------------------------------------


def top_carriers(ranking: DataFrame, n: int = TOP_CARRIERS) -> DataFrame:
    """Busiest carriers of the ranking, with volume, rate and status."""
    return (
        ranking.orderBy(F.desc("total_shipments"), "carrier_id")
        .limit(n)
        .select("carrier_id", "carrier_name", "total_shipments", "actual_otif_pct", "sla_status")
    )


def cost_otif_scatter(model: Model) -> DataFrame:
    sheet = evaluate(
        model,
        ["freight_cost_per_kg_weighted", "otif_rate", "total_shipments"],
        by=["dim_carrier.carrier_id", "dim_carrier.carrier_name"],
    )
    return sheet.withColumns(
        {
            "freight_cost_per_kg_weighted": half_up(F.col("freight_cost_per_kg_weighted"), 6),
            "otif_rate": half_up(F.col("otif_rate"), 6),
        }
    )


def mode_variance(fact: DataFrame, carriers: DataFrame) -> DataFrame:
    """Change of freight spend by transport mode from one month with freight to the next.

    Combined modes such as Road/Air are modes of their own.
    """
    month = month_start(F.col("actual_delivery_date")).alias("month")
    modes = tally(fact, "carrier_id", month).join(
        carriers.select("carrier_id", "transport_mode"), "carrier_id"
    )
    spend = merge_tallies(modes, "transport_mode", "month")
    previous = F.lag("freight").over(Window.partitionBy("transport_mode").orderBy("month"))
    return spend.select(
        "transport_mode",
        month_label(F.col("month")).alias("delivery_month"),
        F.col("freight").alias("freight_usd"),
        previous.alias("previous_freight_usd"),
        (F.col("freight") - previous).alias("variance_usd"),
    )


def slicer_sheet(
    model: Model, tiers: list[str], modes: list[str], first: date, last: date
) -> DataFrame:
    """Headline measures per carrier under the tier, mode and date slicers."""
    sheet = evaluate(
        model,
        ["total_shipments", "total_freight_spend_usd", "on_time_rate", "otif_rate"],
        by=["dim_carrier.carrier_id", "dim_carrier.carrier_tier", "dim_carrier.transport_mode"],
        context={
            "dim_carrier.carrier_tier": one_of(*tiers),
            "dim_carrier.transport_mode": one_of(*modes),
            f"{FACT}.actual_delivery_date": between(F.lit(first), F.lit(last)),
        },
    )
    return sheet.withColumns(
        {c: half_up(F.col(c), 6) for c in ("on_time_rate", "otif_rate")}
    )


# -- warehouses ------------------------------------------------------------


def region_matrix(fact: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Warehouses, region subtotals (``level`` 1) and the grand total (``level`` 3)."""
    per_warehouse = tally(fact, "destination_warehouse_id").join(
        warehouses.select("warehouse_id", "region"),
        F.col("destination_warehouse_id") == F.col("warehouse_id"),
    )
    rolled = per_warehouse.rollup("region", "warehouse_id").agg(
        F.grouping_id().cast("int").alias("level"),
        *[F.sum(c).alias(c) for c in ("shipments", "weight", "freight", "otif")],
    )
    return rolled.select(
        "region",
        F.col("warehouse_id").cast("string").alias("warehouse_id"),
        "level",
        F.col("weight").alias("inbound_weight_kg"),
        F.col("freight").alias("freight_cost_usd"),
        pct_of_shipments("otif").alias("otif_pct"),
    )


# -- suppliers -------------------------------------------------------------


def top_risk_suppliers(reliability: DataFrame, n: int = TOP_RISK_SUPPLIERS) -> DataFrame:
    return (
        reliability.orderBy(F.desc("damage_rate_pct"), "supplier_id")
        .limit(n)
        .select("supplier_id", "supplier_name", "category", "country", "damage_rate_pct")
    )


def delay_decomposition(fact: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Delay days from country down to category, supplier and reason.

    ``net_delay_days`` is the signed sum (early arrivals count against late ones);
    ``late_days`` and ``late_shipments`` cover delayed shipments only.
    """
    late = is_delayed(F.col("delay_reason"))
    leaves = fact.groupBy("supplier_id", "delay_reason").agg(
        F.sum("transit_delay_days").alias("net_delay_days"),
        F.sum(F.when(late, F.col("transit_delay_days")).otherwise(0)).alias("late_days"),
        F.count_if(late).alias("late_shipments"),
    )
    levels = ["country", "category", "supplier_name", "delay_reason"]
    return (
        leaves.join(
            suppliers.select("supplier_id", "country", "category", "supplier_name"), "supplier_id"
        )
        .rollup(*levels)
        .agg(
            F.grouping_id().cast("int").alias("level"),
            F.sum("net_delay_days").alias("net_delay_days"),
            F.sum("late_days").alias("late_days"),
            F.sum("late_shipments").alias("late_shipments"),
        )
    )
