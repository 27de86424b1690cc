"""Bronze to Silver: the not-null gate and the derived columns of each feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightmill.contracts import Contract
from freightmill.functions.keys import shipment_hash
from freightmill.functions.labels import carrier_tier, risk_profile
from freightmill.functions.temporal import civil_date, civil_datetime
from freightmill.sources.files import conform
from freightmill.sources.json_records import BROKEN

GATE_COLUMNS = ("shipment_id", "order_id")


def _gate() -> Column:
    return F.expr(" AND ".join(f"{name} IS NOT NULL" for name in GATE_COLUMNS))


def accepted(shipments: DataFrame) -> DataFrame:
    return shipments.filter(_gate())


def rejection_reason(feed: DataFrame, contract: Contract) -> Column:
    """Why a typed row must not go on: NULL for a good one.

    A row is refused when it did not fit its file's format, when a required value of it could
    not be read, or when the feed's gate columns are missing.
    """
    have = set(feed.columns)
    tests = []
    if "_corrupt_record" in have:
        flaw = F.col("_flaw") if "_flaw" in have else F.lit(None).cast("string")
        told = F.concat_ws(": ", F.lit("malformed record"), F.nullif(flaw, F.lit(BROKEN)))
        tests.append(F.when(F.col("_corrupt_record").isNotNull(), told))
    if "_unreadable_columns" in have:
        required = F.array(*[F.lit(c) for c in contract.required])
        lost = F.array_intersect("_unreadable_columns", required)
        text = F.concat(F.lit("unreadable: "), F.array_join(lost, ", "))
        tests.append(F.when(F.size(lost) > 0, text))
    gate = [c for c in GATE_COLUMNS if c in have]
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), c) for c in gate]))
    if gate:
        text = F.concat(F.lit("missing: "), F.array_join(missing, ", "))
        tests.append(F.when(F.size(missing) > 0, text))
    return F.coalesce(*tests, F.lit(None).cast("string"))


def split_feed(raw: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """A raw text feed as (typed good rows, refused rows as they came with a ``_reason``).

    Every landed row is in exactly one of the two.
    """
    kept = F.struct(*[F.col(f"`{c}`") for c in raw.columns])
    typed = conform(raw.withColumn("_raw", kept), contract)
    judged = typed.withColumn("_reason", rejection_reason(typed, contract))
    good = judged.where("_reason IS NULL").drop("_reason", "_raw", "_corrupt_record", "_flaw")
    return good, judged.where("_reason IS NOT NULL").select("_raw.*", "_reason")


def quarantined(shipments: DataFrame) -> DataFrame:
    return shipments.filter(~_gate())


def with_gate_status(shipments: DataFrame) -> DataFrame:
    return shipments.withColumn("gate_status", F.when(_gate(), "ACCEPTED").otherwise("REJECTED"))


def _is_text(frame: DataFrame, name: str) -> bool:
    return isinstance(frame.schema[name].dataType, T.StringType)


def enrich_shipments(shipments: DataFrame) -> DataFrame:
    """Gate, typed dates, delay, on-time-in-full flag, unit cost and row key.

    Dates arriving as text are parsed in place; the ``*_dt`` names are kept beside
    them for readers of the lake tables.
    """
    parsers = {
        "order_date": civil_datetime,
        "promised_delivery_date": civil_date,
        "actual_delivery_date": civil_date,
    }
    text = {n: parse for n, parse in parsers.items() if _is_text(shipments, n)}
    typed = accepted(shipments).withColumns({n: parse(F.col(n)) for n, parse in text.items()})
    return typed.selectExpr(
        "*",
        "order_date AS order_date_dt",
        "promised_delivery_date AS promised_delivery_dt",
        "actual_delivery_date AS actual_delivery_dt",
        "transit_days - promised_transit_days AS transit_delay_days",
        "CASE WHEN on_time_flag = 1 AND in_full_flag = 1 THEN 1 ELSE 0 END AS otif_compliance_flag",
        "try_cast(round(try_divide(freight_cost_usd, weight_kg), 4) AS DECIMAL(10,4)) "
        "AS freight_cost_per_kg",
    ).withColumn("shipment_hash_key", shipment_hash(F.col("shipment_id"), F.col("order_date")))


def enrich_carriers(carriers: DataFrame) -> DataFrame:
    return carriers.withColumn("carrier_tier", carrier_tier(F.col("sla_target_pct")))


def enrich_warehouses(warehouses: DataFrame) -> DataFrame:
    yearly = F.col("daily_op_cost_usd") * 365
    per_sqft = F.round(F.try_divide(yearly, F.col("capacity_sqft").cast("decimal(20,0)")), 2)
    return warehouses.withColumn("cost_per_sqft", per_sqft.try_cast("decimal(10,2)"))


def enrich_suppliers(suppliers: DataFrame) -> DataFrame:
    return suppliers.withColumn("risk_profile", risk_profile(F.col("reliability_rating")))
