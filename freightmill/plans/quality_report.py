"""All contract checks of the star schema in one report per kind."""

from __future__ import annotations

from pyspark.sql import DataFrame

from freightmill.contracts import (
    FACT_SHIPMENT,
    SILVER_CARRIERS,
    SILVER_SUPPLIERS,
    SILVER_WAREHOUSES,
    Contract,
)
from freightmill.operators.quality import (
    check_domain,
    check_not_null,
    check_references,
    check_unique,
)
from freightmill.sources.lake import stack

# Model table -> contract it is held to.
CHECKED: dict[str, Contract] = {
    "shipments": FACT_SHIPMENT,
    "carriers": SILVER_CARRIERS,
    "warehouses": SILVER_WAREHOUSES,
    "suppliers": SILVER_SUPPLIERS,
}

# Fact column -> (dimension, its key).
REFERENCES = {
    "carrier_id": ("carriers", "carrier_id"),
    "destination_warehouse_id": ("warehouses", "warehouse_id"),
    "supplier_id": ("suppliers", "supplier_id"),
}


def not_null_report(tables: dict[str, DataFrame]) -> DataFrame:
    return stack([check_not_null(tables[t], CHECKED[t]) for t in CHECKED if t in tables])


def domain_report(tables: dict[str, DataFrame]) -> DataFrame:
    return stack([check_domain(tables[t], CHECKED[t]) for t in CHECKED if t in tables])


def unique_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Business keys. On the fact it also finds a shipment loaded by two batches."""
    return stack(
        [
            check_unique(tables[t], CHECKED[t].name, list(key))
            for t in CHECKED
            if t in tables
            for key in CHECKED[t].unique
        ]
    )


def orphan_report(tables: dict[str, DataFrame]) -> DataFrame:
    references = {
        column: (tables[dimension], key)
        for column, (dimension, key) in REFERENCES.items()
        if dimension in tables
    }
    return check_references(tables["shipments"], references, "shipments")
