"""Files in, lake and star schema out, in a fresh folder per test."""

import json
from datetime import date
from decimal import Decimal

import pandas as pd
import pytest
from helpers import values
from pyspark.sql import functions as F

from freightmill.contracts import CARRIERS, FACT_SHIPMENT, FEEDS, SHIPMENTS, TELEMATICS
from freightmill.operators.batch_replace import load_day
from freightmill.operators.enrich import split_feed
from freightmill.plans import medallion, star
from freightmill.plans.star import load_star, read_dimension, read_fact, retire_loads
from freightmill.session import build_session
from freightmill.sources.files import (
    UNREADABLE,
    conform,
    read_csv_feed,
    read_csv_text,
    read_json_feed,
    read_json_text,
    read_landing,
)
from freightmill.sources.lake import (
    append_evolving,
    overwrite_partitioned,
    read_table,
    write_csv,
)

CARRIERS_CSV = """carrier_id,carrier_name,transport_mode,base_rate_per_kg,sla_target_pct
C1,One,Road,2.45,98.0
C2,Two,Sea,0.85,75.0
"""
WAREHOUSES_CSV = """warehouse_id,name,city,country,region,capacity_sqft,daily_op_cost_usd
W1,First,A,X,North,500000,12500
W2,Second,B,Y,South,420000,10800
"""
SUPPLIERS_CSV = """supplier_id,supplier_name,category,country,agreed_lead_days,reliability_rating,contract_sla_pct
P1,Ann,Parts,X,5,4.61,95.0
P2,Bob,Parts,Y,7,3.91,96.0
"""
SHIPMENT_HEADER = ",".join(SHIPMENTS.columns)
SHIPMENTS_CSV = f"""{SHIPMENT_HEADER}
S1,O1,P1,W1,C1,2024-03-01 08:30:00,2024-03-06,2024-03-05,4,5,1,1,100.00,10,250.00,0,None,Delivered
S2,O2,P1,W2,C2,2024-03-01 09:00:00,2024-03-06,2024-03-08,7,5,0,1,50.00,5,80.00,0,Customs Hold,Delivered
S3,O3,P2,W1,C1,2024-03-02 10:00:00,2024-03-07,2024-04-01,30,5,0,0,10.00,1,99.99,1,Weather Disruption,Delivered
S4,,P2,W1,C1,2024-03-02 10:00:00,2024-03-07,2024-03-06,4,5,1,1,10.00,1,5.00,0,None,Delivered
"""
FLEET = [
    {"telematics_id": "T1", "vehicle_id": "V1", "timestamp": "2024-03-01T05:00:00Z",
     "speed_kmh": 50.5, "fuel_consumption_l_100km": 25.5, "engine_temp_celsius": 90.0,
     "idle_minutes_today": 15, "maintenance_alert_flag": 0, "gps_latitude": 40.1,
     "gps_longitude": -70.2},
    {"telematics_id": "T2", "vehicle_id": "V1", "timestamp": "never", "speed_kmh": 0.0,
     "fuel_consumption_l_100km": 0.0, "engine_temp_celsius": 101.0, "idle_minutes_today": 20,
     "maintenance_alert_flag": 1, "gps_latitude": 41.0, "gps_longitude": -71.0},
]


@pytest.fixture
def landing(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for name, text in {
        "carriers": CARRIERS_CSV, "warehouses": WAREHOUSES_CSV, "suppliers": SUPPLIERS_CSV,
        "shipments": SHIPMENTS_CSV,
    }.items():
        (raw / f"{name}.csv").write_text(text)
    (raw / "fleet_telematics.json").write_text(json.dumps(FLEET, indent=2))
    return tmp_path


def test_feeds_are_typed_and_stamped(spark, landing):
    feeds = read_landing(spark, str(landing / "raw"))
    typed = {n: conform(f, FEEDS[n]) for n, f in feeds.items()}
    labels = {n: f.select("_source_system").distinct().first()[0] for n, f in feeds.items()}
    assert labels == {"carriers": "ERP", "warehouses": "WMS", "suppliers": "SRM",
                      "shipments": "TMS", "fleet_telematics": "IoT_Hub"}
    assert dict(feeds["carriers"].dtypes)["base_rate_per_kg"] == "string"
    carriers = typed["carriers"]
    assert [carriers.schema[a.name].dataType for a in CARRIERS.attributes] == [
        a.dtype for a in CARRIERS.attributes
    ]
    row = carriers.orderBy("carrier_id").first()
    assert row.base_rate_per_kg == Decimal("2.4500")
    assert row._source_file.endswith("/raw/carriers.csv")
    assert row._ingested_at is not None
    fleet = typed["fleet_telematics"].orderBy("telematics_id").collect()
    assert str(fleet[0].timestamp) == "2024-03-01 05:00:00"
    assert fleet[1].timestamp is None and fleet[1][UNREADABLE] == ["timestamp"]


def test_json_lines_read_the_same(spark, landing):
    lines = landing / "lines.json"
    lines.write_text("\n".join(json.dumps(r) for r in FLEET))
    one = read_json_feed(spark, str(lines), TELEMATICS)
    array = read_json_feed(
        spark, str(landing / "raw" / "fleet_telematics.json"), TELEMATICS, array_document=True
    )
    assert values(one, *TELEMATICS.columns) == values(array, *TELEMATICS.columns)


def test_columns_are_matched_by_name(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("sla_target_pct,carrier_id,fleet_size\nabc,C1,12\n,C2,13\n")
    feed = read_csv_feed(spark, str(path), CARRIERS)
    assert values(feed, "carrier_id", "carrier_name", "sla_target_pct", "fleet_size",
                  UNREADABLE) == [
        ("C1", None, None, "12", ["sla_target_pct"]), ("C2", None, None, "13", []),
    ]


def test_tables_evolve_by_added_columns(spark, tmp_path):
    old = spark.sql("SELECT 1 AS id, 'x' AS a")
    new = spark.sql("SELECT 2 AS id, 'y' AS a, 9 AS added")
    assert values(append_evolving(old, new)) == [(1, "x", None), (2, "y", 9)]
    path = str(tmp_path / "t")
    old.write.parquet(path)
    new.write.mode("append").parquet(path)
    assert values(read_table(spark, path, merge_schema=True), "id", "added") == [(1, None), (2, 9)]


def test_partition_overwrite_leaves_other_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    overwrite_partitioned(spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b') AS t(v, d)"), path, "d")
    overwrite_partitioned(spark.sql("SELECT 9 AS v, 'b' AS d"), path, "d")
    assert values(spark.read.parquet(path), "v", "d") == [(1, "a"), (9, "b")]
    overwrite_partitioned(spark.sql("SELECT 7 AS v, 'c' AS d"), path, "d", replace_all=True)
    assert values(spark.read.parquet(path), "v", "d") == [(7, "c")]


def test_the_whole_run(spark, landing):
    lake_dir = str(landing / "lake")
    lake = medallion.run(spark, str(landing / "raw"), lake_dir, "2024-03-01")

    assert values(read_table(spark, f"{lake.silver}/shipments"), "shipment_id", "order_day") == [
        ("S1", date(2024, 3, 1)), ("S2", date(2024, 3, 1)), ("S3", date(2024, 3, 2)),
    ]
    assert values(read_table(spark, f"{lake.silver}/shipments_quarantine"), "shipment_id") == [
        ("S4",)
    ]
    assert values(
        read_table(spark, f"{lake.gold}/gold_carrier_scorecard"),
        "carrier_id", "total_shipments", "actual_on_time_pct", "sla_breach_flag",
    ) == [("C1", 2, Decimal("50.00"), 1), ("C2", 1, Decimal("0.00"), 1)]
    assert values(
        read_table(spark, f"{lake.gold}/gold_warehouse_monthly"),
        "warehouse_id", "delivery_month", "total_inbound_weight_kg",
    ) == [("W1", "2024-03", Decimal("100.00")), ("W1", "2024-04", Decimal("10.00")),
          ("W2", "2024-03", Decimal("50.00"))]
    exported = spark.read.option("header", True).csv(f"{lake.export}/gold_supplier_reliability")
    assert values(exported, "supplier_id", "damage_rate_pct") == [("P1", "0.00"), ("P2", "100.00")]
    assert spark.read.option("header", True).csv(f"{lake.export}/silver_shipments").count() == 3
    kpis = spark.read.json(f"{lake.export}/summary/kpis").first()
    assert (kpis.total_shipments, kpis.active_suppliers, kpis.damage_rate_pct) == (3, 2, 33.33)
    assert spark.read.json(f"{lake.export}/summary/delay_breakdown").count() == 2

    fact = read_fact(spark, lake.star)
    assert values(fact, "shipment_id") == [("S1",), ("S2",)]
    assert set(FACT_SHIPMENT.columns) < set(fact.columns)
    assert values(read_dimension(spark, lake.star, "dim_carrier"), "carrier_id", "is_active") == [
        ("C1", 1), ("C2", 1),
    ]
    assert read_dimension(spark, lake.star, "dim_date").count() == 366

    # The next day, a carrier is renamed, one is new and the file shrinks to it.
    first_keys = dict(values(read_dimension(spark, lake.star, "dim_carrier"), "carrier_id",
                             "carrier_key"))
    started = values(read_dimension(spark, lake.star, "dim_carrier"), "carrier_id",
                     "effective_start_date")
    (landing / "raw" / "carriers.csv").write_text(
        CARRIERS_CSV.replace("C1,One", "C1,Uno").replace("C2,Two", "C3,Three")
    )
    for _ in range(2):
        lake = medallion.run(spark, str(landing / "raw"), lake_dir, date(2024, 3, 2))
        carriers = read_dimension(spark, lake.star, "dim_carrier")
        names = values(carriers, "carrier_id", "carrier_name")
        assert names == [("C1", "Uno"), ("C2", "Two"), ("C3", "Three")]
        keys = dict(values(carriers, "carrier_id", "carrier_key"))
        assert {k: keys[k] for k in first_keys} == first_keys and keys["C3"] == 3
        assert values(carriers, "carrier_id", "effective_start_date")[:2] == started
        loaded = read_fact(spark, lake.star)
        assert values(loaded, "shipment_id") == [("S1",), ("S2",), ("S3",)]

    spark.sql("CREATE DATABASE IF NOT EXISTS freightmill_test")
    for _ in range(2):
        medallion.publish_catalog(spark, lake, "freightmill_test")
    assert spark.table("freightmill_test.fact_shipment_fulfillment").count() == 3
    assert spark.table("freightmill_test.fact_fleet_telematics").count() == 1
    layout = spark.sql("SHOW PARTITIONS freightmill_test.fact_shipment_fulfillment").count()
    assert layout == 2
    refused = read_table(spark, f"{lake.silver}/fleet_telematics_quarantine")
    assert values(refused, "telematics_id", "timestamp", "_reason") == [
        ("T2", "never", "unreadable: timestamp")
    ]
    assert spark.table("freightmill_test.dim_carrier").count() == 2


def test_a_failed_load_publishes_nothing(spark, landing):
    lake = medallion.run(spark, str(landing / "raw"), str(landing / "lake"), "2024-03-01")
    conflicting = read_table(spark, f"{lake.silver}/suppliers").selectExpr(
        "* EXCEPT (supplier_id)", "'P1' AS supplier_id"
    )
    conflicting.write.mode("overwrite").parquet(f"{landing}/bad/suppliers")
    for name in ("carriers", "warehouses", "shipments"):
        table = read_table(spark, f"{lake.silver}/{name}")
        if name == "carriers":
            table = table.selectExpr("* EXCEPT (carrier_name)", "'changed' AS carrier_name")
        table.write.mode("overwrite").parquet(f"{landing}/bad/{name}")
    with pytest.raises(Exception, match="conflicting rows"):
        load_star(spark, f"{landing}/bad", lake.star, "2024-03-02")
    names = values(read_dimension(spark, lake.star, "dim_carrier"), "carrier_name")
    assert names == [("One",), ("Two",)]
    assert values(read_fact(spark, lake.star), "shipment_id") == [("S1",), ("S2",)]


def test_a_load_cut_short_is_repaired_by_the_next(spark, landing, monkeypatch):
    lake = medallion.run(spark, str(landing / "raw"), str(landing / "lake"), "2024-03-01")
    keys = values(read_dimension(spark, lake.star, "dim_supplier"), "supplier_id", "supplier_key")

    def failing(batch, *place):
        """The write itself fails, in a task."""
        broken = F.when(F.col("shipment_id").isNotNull(), F.raise_error(F.lit("lost"))).cast("int")
        load_day(batch.withColumn("quantity_units", broken), *place)

    for day in ("2024-03-02", "2024-03-01"):
        with monkeypatch.context() as broken:
            broken.setattr(star, "load_day", failing)
            with pytest.raises(Exception, match="lost"):
                load_star(spark, lake.silver, lake.star, day)
        assert values(read_fact(spark, lake.star), "shipment_id") == [("S1",), ("S2",)]
    load_id = load_star(spark, lake.silver, lake.star, "2024-03-02")
    assert star.published_load(spark, lake.star) == load_id
    assert values(read_fact(spark, lake.star), "shipment_id") == [("S1",), ("S2",), ("S3",)]
    before = values(read_fact(spark, lake.star))
    assert len(retire_loads(spark, lake.star)) == 3
    assert retire_loads(spark, lake.star) == []
    assert values(read_fact(spark, lake.star)) == before
    again = read_dimension(spark, lake.star, "dim_supplier")
    assert values(again, "supplier_id", "supplier_key") == keys
    assert read_table(spark, f"{lake.star}/{star.LOAD_LOG}").count() == 2


def test_nothing_is_published_before_the_first_load(spark, tmp_path):
    assert read_dimension(spark, str(tmp_path), "dim_carrier") is None
    assert read_fact(spark, str(tmp_path)) is None


def test_gold_covers_all_landings(spark, landing):
    """Each day lands alone; a late row of the first day comes with the second."""
    raw, lake_dir = landing / "raw", str(landing / "lake")
    lines = SHIPMENTS_CSV.splitlines()
    (raw / "shipments.csv").write_text("\n".join(lines[:2]) + "\n")
    medallion.run(spark, str(raw), lake_dir, "2024-03-01", export=False)
    (raw / "shipments.csv").write_text("\n".join([lines[0], *lines[2:]]) + "\n")
    spark.sql("CREATE DATABASE IF NOT EXISTS freightmill_days")
    for _ in range(2):
        lake = medallion.run(
            spark, str(raw), lake_dir, "2024-03-02", export=False, catalog="freightmill_days"
        )
        gold = read_table(spark, f"{lake.gold}/gold_carrier_scorecard")
        assert values(gold, "carrier_id", "total_shipments") == [("C1", 2), ("C2", 1)]
    assert spark.table("freightmill_days.fact_shipment_fulfillment").count() == 3


def test_csv_quotes_and_breaks(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text(
        'carrier_id,carrier_name\nC1,"ACME ""Fast"", Inc"\nC2,"two\nlines"\nC3,a,b\nC4\n'
    )
    whole = read_csv_text(spark, str(path), multi_line=True).cache()
    good = whole.where("_corrupt_record IS NULL")
    assert values(good, "carrier_id", "carrier_name") == [
        ("C1", 'ACME "Fast", Inc'), ("C2", "two\nlines"),
    ]
    bad = whole.where("_corrupt_record IS NOT NULL")
    assert sorted(r[0].strip() for r in bad.select("_corrupt_record").collect()) == ["C3,a,b", "C4"]
    with pytest.raises(ValueError, match="multi_line"):
        read_csv_text(spark, str(path))
    accepted, refused = split_feed(whole, CARRIERS)
    assert accepted.count() + refused.count() == whole.count() == 4
    assert values(refused, "_reason") == [("malformed record",), ("malformed record",)]


def test_csv_folder_with_two_headers(spark, tmp_path):
    folder = tmp_path / "carriers.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("carrier_id,transport_mode\nC1,Road\n")
    (folder / "b.csv").write_text("transport_mode,fleet,carrier_id\nSea,7,C2\n")
    feed = read_csv_feed(spark, str(folder), CARRIERS)
    assert values(feed, "carrier_id", "transport_mode", "fleet") == [
        ("C1", "Road", None), ("C2", "Sea", "7"),
    ]


def test_written_csv_reads_back(spark, tmp_path):
    rows = [("C1", 'say ""hi"", "x"'), ("C2", "a,b"), ("C3", 'end"')]
    write_csv(spark.createDataFrame(rows, "carrier_id string, carrier_name string"), f"{tmp_path}/o")
    assert values(read_csv_text(spark, f"{tmp_path}/o"), "carrier_id", "carrier_name") == rows
    parts = [pd.read_csv(p) for p in (tmp_path / "o").glob("part-*.csv")]
    frame = pd.concat(parts)
    assert sorted(frame.itertuples(index=False, name=None)) == rows


def test_json_keeps_fields_and_broken_records(spark, tmp_path):
    path = tmp_path / "t.json"
    path.write_text('{"telematics_id": "T1", "tyre_psi": 31.5, "tags": [1]}\n{"telematics_id": \n')
    feed = read_json_text(spark, str(path), TELEMATICS)
    rows = {r.telematics_id: r for r in feed.collect()}
    assert rows["T1"]._extra == {"tyre_psi": "31.5", "tags": "[1]"}
    assert rows[None]._corrupt_record == '{"telematics_id": '
    accepted, refused = split_feed(feed, TELEMATICS)
    assert accepted.count() == 1 and values(refused, "_reason") == [("malformed record",)]


def test_unreadable_rows_are_refused_with_their_text(spark, tmp_path):
    header = ",".join(SHIPMENTS.columns)
    good = "S1,O1,P1,W1,C1,2024-03-01T08:30:00+05:00,2024-03-06,2024-03-05,4,5,1,1,1,1,1,0,None,D"
    path = tmp_path / "s.csv"
    path.write_text(f"{header}\n{good}\n{good.replace('2024-03-01T08:30:00+05:00', 'soon')}\n")
    accepted, refused = split_feed(read_csv_text(spark, str(path)), SHIPMENTS)
    assert str(accepted.first().order_date) == "2024-03-01 03:30:00"
    assert values(refused, "order_date", "_reason") == [("soon", "unreadable: order_date")]


def test_preset_session_values_survive(spark):
    kept = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256m")
    try:
        again = build_session("preset")
        assert again.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "256m"
        assert again.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", kept)
