"""Dimension loads that rewrite only the buckets their changes fall into."""

import pytest
from helpers import values
from pyspark.sql import functions as F

from freightmill.contracts import FACT_SHIPMENT
from freightmill.operators.upsert import changed_rows, key_bucket, row_digest
from freightmill.plans import star
from freightmill.plans.star import load_star, read_dimension, retire_loads
from freightmill.sources.lake import list_folders, overwrite_table


def write_silver(spark, folder, suppliers):
    overwrite_table(
        spark.sql(
            "SELECT 'C1' AS carrier_id, 'One' AS carrier_name, 'Road' AS transport_mode, "
            "2.45BD AS base_rate_per_kg, 98.0BD AS sla_target_pct, 'T' AS carrier_tier"
        ),
        f"{folder}/carriers",
    )
    overwrite_table(
        spark.sql(
            "SELECT 'W1' AS warehouse_id, 'First' AS name, 'A' AS city, 'X' AS country, "
            "'North' AS region, 5L AS capacity_sqft, 1.0BD AS daily_op_cost_usd, 2.0BD AS cost_per_sqft"
        ),
        f"{folder}/warehouses",
    )
    overwrite_table(suppliers, f"{folder}/suppliers")
    overwrite_table(spark.createDataFrame([], FACT_SHIPMENT.struct), f"{folder}/shipments")


def some_suppliers(spark, count):
    return spark.range(count).selectExpr(
        "concat('P', id) AS supplier_id", "concat('name ', id) AS supplier_name",
        "'Parts' AS category", "'X' AS country", "CAST(id % 9 AS INT) AS agreed_lead_days",
        "4.50BD AS reliability_rating", "95.0BD AS contract_sla_pct", "'Low' AS risk_profile",
    )


def folders_of(spark, root):
    base = f"{root}/star/dimensions/dim_supplier"
    return {f: list_folders(spark, f"{base}/{f}") for f in list_folders(spark, base)}


def test_only_buckets_with_changes_are_rewritten(spark, tmp_path):
    silver, place = f"{tmp_path}/silver", f"{tmp_path}/star"
    first = some_suppliers(spark, 400)
    write_silver(spark, silver, first)
    one = load_star(spark, silver, place, "2024-03-01")
    assert len(folders_of(spark, tmp_path)[f"load={one}"]) == 32
    keys = dict(values(read_dimension(spark, place, "dim_supplier"), "supplier_id", "supplier_key"))
    assert sorted(keys.values()) == list(range(1, 401))

    # The same rows again: nothing is written.
    two = load_star(spark, silver, place, "2024-03-02")
    assert set(folders_of(spark, tmp_path)) == {f"load={one}"}
    assert two != one and star.published_load(spark, place) == two
    assert dict(values(read_dimension(spark, place, "dim_supplier"), "supplier_id",
                       "supplier_key")) == keys

    # Two rows change, one is new and the feed no longer lists half of the others.
    renamed = first.withColumn(
        "supplier_name",
        F.when(F.col("supplier_id").isin("P7", "P8"), F.lit(None)).otherwise(F.col("supplier_name")),
    ).where("CAST(substring(supplier_id, 2) AS INT) < 200")
    new = some_suppliers(spark, 401).where("supplier_id = 'P400'")
    write_silver(spark, silver, renamed.unionByName(new))
    three = load_star(spark, silver, place, "2024-03-03")
    changed = spark.sql("SELECT explode(array('P7', 'P8', 'P400')) AS supplier_id")
    wanted = {r[0] for r in changed.select(key_bucket("supplier_id", 32)).collect()}
    rewritten = folders_of(spark, tmp_path)[f"load={three}"]
    assert set(rewritten) == {f"bucket={b}" for b in wanted} and len(wanted) <= 3
    now = read_dimension(spark, place, "dim_supplier")
    assert now.count() == 401 and "_row_digest" not in now.columns
    after = dict(values(now, "supplier_id", "supplier_key"))
    assert {k: after[k] for k in keys} == keys and after["P400"] == 401
    names = dict(values(now, "supplier_id", "supplier_name"))
    assert names["P7"] is None and names["P9"] == "name 9" and names["P399"] == "name 399"

    # Buckets that are still in use outlive the loads that wrote them.
    before = values(now)
    retire_loads(spark, place)
    assert set(folders_of(spark, tmp_path)) == {f"load={one}", f"load={three}"}
    assert values(read_dimension(spark, place, "dim_supplier")) == before
    assert retire_loads(spark, place) == []


def test_a_first_load_without_rows(spark, tmp_path):
    silver, place = f"{tmp_path}/silver", f"{tmp_path}/star"
    write_silver(spark, silver, some_suppliers(spark, 0))
    load_star(spark, silver, place, "2024-03-01")
    empty = read_dimension(spark, place, "dim_supplier")
    assert empty.count() == 0 and "supplier_key" in empty.columns
    write_silver(spark, silver, some_suppliers(spark, 3))
    load_star(spark, silver, place, "2024-03-02")
    assert read_dimension(spark, place, "dim_supplier").count() == 3


def test_digests_tell_values_apart(spark):
    rows = [("k1", "a", None), ("k2", None, "a"), ("k3", "", "a"), ("k4", "a", "")]
    frame = spark.createDataFrame(rows, "k string, x string, y string")
    digests = frame.select(row_digest(["x", "y"])).distinct()
    assert digests.count() == 4
    told = frame.withColumn("d", row_digest(["x", "y"]))
    stored = told.withColumn("d", F.when(F.col("k") != "k2", F.col("d")).otherwise(F.lit("old")))
    fresh = told.unionByName(told.limit(1).withColumn("k", F.lit("k9")))
    assert values(changed_rows(fresh, stored, "k", "d"), "k") == [("k2",), ("k9",)]


@pytest.mark.parametrize("buckets", [1, 7, 32])
def test_buckets_are_within_range(spark, buckets):
    found = some_suppliers(spark, 500).select(key_bucket("supplier_id", buckets).alias("b"))
    assert {r[0] for r in found.collect()} == set(range(buckets))
