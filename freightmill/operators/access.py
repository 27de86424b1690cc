"""Row-level security: a user's entitlements decide which dimension rows, and so
which facts, are visible."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def permitted(
    dimension: DataFrame, entitlements: DataFrame, user: str, attribute: str
) -> DataFrame:
    """Dimension rows whose ``attribute`` is granted to ``user`` (all grants add up)."""
    grants = entitlements.filter(F.col("user_name") == user).select(attribute).distinct()
    return dimension.join(grants, attribute, "left_semi")


def visible(fact: DataFrame, fact_key: str, allowed: DataFrame, dimension_key: str) -> DataFrame:
    """Facts, or per-key totals of them, that point at an allowed dimension row."""
    keys = allowed.select(F.col(dimension_key).alias(fact_key))
    return fact.join(keys, fact_key, "left_semi")
