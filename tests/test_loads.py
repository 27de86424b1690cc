from datetime import date, datetime
from decimal import Decimal

import pytest
from helpers import plan_text, shipment, shipments, values
from pyspark.sql import functions as F

from freightmill.contracts import FACT_SHIPMENT
from freightmill.operators.batch_replace import (
    day_batch,
    day_path,
    fact_rows,
    load_day,
    replace_day,
)
from freightmill.operators.enrich import enrich_shipments
from freightmill.operators.upsert import assign_surrogates, upsert
from freightmill.plans.star import batch_day, calendar_span
from freightmill.sources.lake import overwrite_partitioned

COLUMNS = ["id", "name"]


def dims(spark, *rows):
    return spark.createDataFrame(list(rows), "id STRING, name STRING, active INT")


def incoming(spark, *rows):
    return spark.createDataFrame(list(rows), "id STRING, name STRING")


def test_upsert_updates_inserts_and_keeps(spark):
    target = dims(spark, ("a", "A", 0), ("b", "B", 0))
    source = incoming(spark, ("b", None), ("c", "C"), ("c", "C"))
    merged = upsert(target, source, "id", COLUMNS, {"active": F.lit(1)})
    assert values(merged) == [("a", "A", 0), ("b", None, 0), ("c", "C", 1)]
    again = upsert(merged, source, "id", COLUMNS, {"active": F.lit(1)})
    assert values(again) == values(merged)


@pytest.mark.parametrize("rows", [[("b", "B1"), ("b", "B2")], [(None, "X")]])
def test_upsert_rejects_ambiguous_sources(spark, rows):
    merged = upsert(dims(spark, ("a", "A", 0)), incoming(spark, *rows), "id", COLUMNS)
    with pytest.raises(Exception, match="upsert source: id is NULL or has conflicting rows"):
        merged.collect()


def test_surrogates_are_dense_and_stable(spark):
    known = [(f"k{i:03d}", i + 1) for i in range(20)]
    fresh = [(f"n{i:03d}", None) for i in range(300)]
    snapshot = spark.createDataFrame(known + fresh, "id STRING, key INT")
    keyed = assign_surrogates(snapshot, "id", "key")
    rows = {r.id: r.key for r in keyed.collect()}
    assert {k: v for k, v in rows.items() if k.startswith("k")} == dict(known)
    assert sorted(rows.values()) == list(range(1, 321))
    assert keyed.schema["key"].dataType == snapshot.schema["key"].dataType
    assert {r.id: r.key for r in assign_surrogates(keyed, "id", "key").collect()} == rows


def test_surrogates_start_at_one(spark):
    snapshot = spark.createDataFrame([("x", None), ("y", None)], "id STRING, key INT")
    assert sorted(r.key for r in assign_surrogates(snapshot, "id", "key").collect()) == [1, 2]


DAY = date(2024, 3, 1)


def silver(spark, *rows):
    return enrich_shipments(shipments(spark, *rows))


def test_replace_day_is_delete_and_insert(spark):
    other_day = datetime(2024, 3, 2)
    target = fact_rows(silver(spark, shipment(1), shipment(2), shipment(3, order_date=other_day)))
    staging = silver(
        spark, shipment(2, quantity_units=99), shipment(4), shipment(5, order_date=other_day)
    )
    loaded = replace_day(target, staging, DAY)
    assert values(loaded, "shipment_id", "quantity_units") == [("S2", 99), ("S3", 10), ("S4", 10)]
    assert loaded.columns == FACT_SHIPMENT.columns
    assert values(replace_day(loaded, staging, DAY)) == values(loaded)


def test_a_moved_shipment_stays_in_its_old_day(spark):
    target = fact_rows(silver(spark, shipment(1), shipment(2, order_date=None)))
    staging = silver(spark, shipment(1, order_date=datetime(2024, 3, 2)))
    loaded = replace_day(target, staging, date(2024, 3, 2))
    assert values(loaded, "shipment_id") == [("S1",), ("S1",), ("S2",)]


def test_load_day_overwrites_one_folder(spark, tmp_path):
    path = str(tmp_path / "fact")
    both = silver(spark, shipment(1), shipment(2), shipment(3, order_date=datetime(2024, 3, 2)))
    for day in (DAY, date(2024, 3, 2)):
        load_day(day_batch(both, day), path, "a", day)

    def stored(load):
        return values(spark.read.parquet(f"{path}/load={load}"), "shipment_id", "order_day")

    expected = [("S1", DAY), ("S2", DAY), ("S3", date(2024, 3, 2))]
    assert stored("a") == expected
    load_day(day_batch(both, DAY), path, "a", DAY)
    assert stored("a") == expected
    load_day(day_batch(both.filter("false"), DAY), path, "b", DAY)
    assert stored("a") == expected
    assert spark.read.parquet(day_path(path, "b", DAY)).count() == 0
    assert day_path(path, "a", DAY).endswith("/load=a/order_day=2024-03-01")


def test_fact_rows_have_contract_types(spark):
    row = fact_rows(silver(spark, shipment(1))).schema
    assert [f.dataType for f in row] == [a.dtype for a in FACT_SHIPMENT.attributes]


def test_batch_day_defaults_to_today():
    assert batch_day("2024-03-01") == DAY
    assert batch_day(DAY) == DAY
    assert batch_day(None) is not None


def test_upsert_keeps_decimal_values(spark):
    target = spark.sql("SELECT 'a' AS id, CAST(1.5 AS DECIMAL(10,4)) AS rate")
    source = spark.sql("SELECT 'a' AS id, CAST(2.25 AS DECIMAL(10,4)) AS rate")
    assert values(upsert(target, source, "id", ["id", "rate"])) == [("a", Decimal("2.2500"))]


def test_a_day_batch_reads_only_its_partition(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows = silver(spark, shipment(1), shipment(2, order_date=datetime(2024, 3, 2)))
    overwrite_partitioned(
        rows.withColumn("order_day", F.col("order_date").cast("date")), path, "order_day"
    )
    batch = day_batch(spark.read.parquet(path), DAY)
    assert values(batch, "shipment_id") == [("S1",)]
    assert "PartitionFilters: [isnotnull(order_day" in plan_text(batch)
    assert len(batch.inputFiles()) >= 1


def test_calendar_span_grows_with_batches(spark):
    batch = fact_rows(silver(spark, shipment(1)))
    assert [str(d) for d in calendar_span(batch, None).first()] == ["2024-03-01", "2024-03-06"]
    known = spark.sql("SELECT DATE'2023-01-01' AS full_date")
    assert [str(d) for d in calendar_span(batch, known).first()] == ["2023-01-01", "2024-03-06"]
    empty = calendar_span(batch.filter("false"), None).first()
    assert tuple(empty) == (None, None)
