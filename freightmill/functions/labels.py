"""Thresholds and the texts they map to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: they must equal the published ones for results to agree ---
TIER_PREMIER = "Tier-1 Premier"
TIER_STANDARD = "Tier-2 Standard"
TIER_ECONOMY = "Tier-3 Economy"
TIER_PREMIER_FROM = "97.0"
TIER_STANDARD_FROM = "94.0"

RISK_LOW = "Low Risk"
RISK_MEDIUM = "Medium Risk"
RISK_HIGH = "High Risk"
RISK_LOW_FROM = "4.5"
RISK_MEDIUM_FROM = "4.0"

NO_DELAY = "None"

QUERY_BREACH = "BREACH"
QUERY_COMPLIANT = "COMPLIANT"
BADGE_BREACH = "🚨 SLA Breach"
BADGE_COMPLIANT = "✅ Compliant"
MEASURE_BREACH = "🚨 SLA Breached"
MEASURE_COMPLIANT = "✅ SLA Compliant"

OTIF_GOOD_FROM_PCT = "80"
DAMAGE_HIGH_ABOVE_PCT = "3.0"
OTIF_TREND_TARGET_PCT = 95.0
RISK_MATRIX_MIN_ORDERS = 10
# --- end of fixed values ---


def _decimal(text: str) -> Column:
    return F.lit(text).cast("decimal(5,2)")


def banded(value: Column, bands: list[tuple[str, str]], below: str) -> Column:
    """First band whose lower bound ``value`` reaches; ``bands`` run high to low."""
    result = None
    for bound, label in bands:
        test = value >= _decimal(bound)
        result = F.when(test, label) if result is None else result.when(test, label)
    return result.otherwise(below)


def carrier_tier(sla_target_pct: Column) -> Column:
    return banded(
        sla_target_pct,
        [(TIER_PREMIER_FROM, TIER_PREMIER), (TIER_STANDARD_FROM, TIER_STANDARD)],
        TIER_ECONOMY,
    )


def risk_profile(reliability_rating: Column) -> Column:
    return banded(
        reliability_rating,
        [(RISK_LOW_FROM, RISK_LOW), (RISK_MEDIUM_FROM, RISK_MEDIUM)],
        RISK_HIGH,
    )


def is_delayed(delay_reason: Column) -> Column:
    return delay_reason.isNotNull() & (delay_reason != NO_DELAY)


def otif_status(otif_pct: Column) -> Column:
    return F.when(otif_pct >= _decimal(OTIF_GOOD_FROM_PCT), "GOOD").otherwise("WARNING")


def target_status(actual_pct: Column, target_pct: Column) -> Column:
    return F.when(actual_pct >= target_pct, "MET").otherwise("MISSED")


def damage_status(damage_pct: Column) -> Column:
    return F.when(damage_pct > _decimal(DAMAGE_HIGH_ABOVE_PCT), "HIGH").otherwise("NORMAL")
