"""Several landings: Gold by day totals over kept dimensions, and what becomes of refused rows."""

import json

import pytest
from helpers import plan_text, values
from pyspark.sql import functions as F
from test_medallion import CARRIERS_CSV, FLEET, SHIPMENT_HEADER, SUPPLIERS_CSV, WAREHOUSES_CSV

from freightmill.operators.day_tally import GRAINS, day_tally, over_days, replace_days
from freightmill.plans import day_totals, incremental, medallion
from freightmill.plans.gold import carrier_scorecard, supplier_reliability, warehouse_monthly
from freightmill.plans.quarantine import ROW_ID, read_refused
from freightmill.plans.star import read_dimension
from freightmill.sources.files import landing_id, read_csv_text
from freightmill.sources.lake import list_folders, read_table


def line(i, day, carrier="C1", cost="250.00", order="O", reason="None"):
    return (
        f"S{i},{order}{i if order else ''},P{1 + i % 2},W{1 + i % 2},{carrier},{day} 08:30:00,"
        f"2024-03-06,2024-03-05,4,5,1,1,100.00,10,{cost},0,{reason},Delivered"
    )


def land(folder, lines, carriers=CARRIERS_CSV):
    folder.mkdir(exist_ok=True)
    (folder / "carriers.csv").write_text(carriers)
    (folder / "warehouses.csv").write_text(WAREHOUSES_CSV)
    (folder / "suppliers.csv").write_text(SUPPLIERS_CSV)
    (folder / "shipments.csv").write_text("\n".join([SHIPMENT_HEADER, *lines]) + "\n")
    (folder / "fleet_telematics.json").write_text(json.dumps(FLEET))
    return str(folder)


FIRST = [
    line(1, "2024-03-01"), line(2, "2024-03-01", "C2"), line(3, "2024-03-02", "C2"),
    line(4, "2024-03-03"), line(5, "2024-03-03", order=""), line(6, "soon"),
]
SECOND = [line(3, "2024-03-02", "C2", "80.00"), line(7, "2024-03-02"), line(8, "2024-03-02", order="")]
ONLY_C1 = "\n".join(CARRIERS_CSV.splitlines()[:2]) + "\n"


@pytest.fixture(scope="module")
def two_landings(spark, tmp_path_factory):
    """The second landing lists carrier C1 alone and comes after a first one with C1 and C2."""
    root = tmp_path_factory.mktemp("landings")
    lake = medallion.run(spark, land(root / "a", FIRST), f"{root}/lake", "2024-03-01", export=False)
    seen = {}
    stale = day_totals.stale_shipments

    def watched(fact, days):
        seen["days"], seen["plan"] = days, plan_text(day_tally(stale(fact, days), "carrier"))
        return stale(fact, days)

    day_totals.stale_shipments = watched
    try:
        medallion.run(
            spark, land(root / "b", SECOND, ONLY_C1), f"{root}/lake", "2024-03-02", export=True
        )
    finally:
        day_totals.stale_shipments = stale
    return lake, seen, root


def test_gold_keeps_entities_that_are_no_longer_listed(spark, two_landings):
    lake, _, _ = two_landings
    gold = read_table(spark, f"{lake.gold}/gold_carrier_scorecard")
    assert values(gold, "carrier_id", "carrier_name", "total_shipments") == [
        ("C1", "One", 3), ("C2", "Two", 2),
    ]
    assert values(read_table(spark, f"{lake.silver}/carriers"), "carrier_id") == [("C1",)]


def test_only_touched_days_are_tallied_again(spark, two_landings):
    lake, seen, _ = two_landings
    assert [str(d) for d in seen["days"]] == ["2024-03-02"]
    scan = next(p for p in seen["plan"].split("\n\n") if "PartitionFilters" in p)
    filters = next(x for x in scan.splitlines() if x.startswith("PartitionFilters"))
    assert "order_day" in filters and "2024-03-02" in filters
    fact = read_table(spark, f"{lake.silver}/shipments")
    assert len(list_days(fact)) == 3
    assert not day_totals.list_folders(spark, f"{lake.totals}/{day_totals.NOTES}")


def list_days(fact):
    return {r[0] for r in fact.select("order_day").distinct().collect()}


def test_gold_equals_the_full_recomputation(spark, two_landings):
    lake, _, _ = two_landings
    fact = read_table(spark, f"{lake.silver}/shipments")
    for name, build, dimension in (
        ("gold_carrier_scorecard", carrier_scorecard, "dim_carrier"),
        ("gold_warehouse_monthly", warehouse_monthly, "dim_warehouse"),
        ("gold_supplier_reliability", supplier_reliability, "dim_supplier"),
    ):
        stored = read_table(spark, f"{lake.gold}/{name}")
        again = build(fact, read_dimension(spark, lake.star, dimension))
        assert stored.dtypes == again.dtypes
        assert values(stored) == values(again) and values(stored)
    kpis = spark.read.json(f"{lake.export}/summary/kpis").first()
    assert (kpis.total_shipments, kpis.active_suppliers) == (5, 2)


def test_days_noted_by_a_job_that_stopped_are_tallied_by_the_next(spark, two_landings, tmp_path):
    lake, _, _ = two_landings
    copy = medallion.Lake(str(tmp_path / "lake"))
    for layer in ("silver/shipments", *(f"totals/{grain}" for grain in GRAINS)):
        name = "order_day"
        stored = read_table(spark, f"{lake.root}/{layer}")
        medallion.overwrite_partitioned(stored, f"{copy.root}/{layer}", name)
    more = read_table(spark, f"{copy.silver}/shipments").where("shipment_id = 'S4'").selectExpr(
        "* EXCEPT (shipment_id)", "'S9' AS shipment_id"
    )
    medallion.add_shipments(copy, more)
    totals = day_totals.read_totals(spark, copy.totals, "carrier")
    assert totals.agg(F.sum("shipments")).first()[0] == 5
    days = day_totals.refresh_totals(spark, f"{copy.silver}/shipments", copy.totals)
    assert [str(d) for d in days] == ["2024-03-03"]
    totals = day_totals.read_totals(spark, copy.totals, "carrier")
    assert totals.agg(F.sum("shipments")).first()[0] == 6
    assert day_totals.refresh_totals(spark, f"{copy.silver}/shipments", copy.totals) == []


def test_replaced_days_as_a_plan(spark, two_landings):
    lake, _, _ = two_landings
    fact = read_table(spark, f"{lake.silver}/shipments").drop("order_day")
    fact = fact.unionByName(fact.limit(1).withColumn("order_date", F.lit(None).cast("timestamp_ntz")))
    changed = fact.withColumn("weight_kg", (F.col("weight_kg") + 1).cast("decimal(10,2)"))
    for grain, keys in GRAINS.items():
        for days in ([], [None], [r[0] for r in fact.select(F.to_date("order_date")).distinct().collect()]):
            test = F.lit(False)
            for day in days:
                test = test | F.to_date("order_date").eqNullSafe(F.lit(day).cast("date"))
            merged = replace_days(day_tally(fact, grain), day_tally(changed.where(test), grain), days)
            whole = fact.where(~test).unionByName(changed.where(test))
            expected = over_days(day_tally(whole, grain), *keys)
            assert values(over_days(merged, *keys)) == values(expected)


def test_refused_rows_outlive_the_next_landing(spark, two_landings):
    lake, _, root = two_landings
    waiting = read_refused(spark, f"{lake.silver}/shipments_quarantine")
    assert values(waiting, "shipment_id", "_reason") == [
        ("S5", "missing: order_id"), ("S6", "unreadable: order_date"), ("S8", "missing: order_id"),
    ]
    assert waiting.select("_landing").distinct().count() == 2
    # Telematics landed twice, in files that are not the same.
    fleet = read_refused(spark, f"{lake.silver}/fleet_telematics_quarantine")
    assert values(fleet, "telematics_id") == [("T2",), ("T2",)]
    landed = sum(read_csv_text(spark, f"{root}/{x}/shipments.csv").count() for x in "ab")
    accepted = read_table(spark, f"{lake.silver}/shipments").count()
    # One of the accepted rows landed twice.
    assert landed == accepted + 1 + waiting.count()


def test_mended_rows_leave_the_quarantine_once(spark, two_landings):
    lake, _, _ = two_landings
    path = f"{lake.silver}/shipments_quarantine"
    ids = dict(values(read_refused(spark, path), "shipment_id", ROW_ID))
    mended = spark.createDataFrame(
        [(ids["S5"], "O5", None), (ids["S6"], "O6", "still no date"), ("unknown", "O7", None)],
        f"{ROW_ID} string, order_id string, note string",
    )
    before = read_table(spark, f"{lake.silver}/shipments").count()
    assert medallion.resubmit(spark, lake, "shipments", mended) == 1
    assert values(read_refused(spark, path), "shipment_id") == [("S6",), ("S8",)]
    stored = read_table(spark, f"{lake.silver}/shipments", merge_schema=True)
    assert stored.count() == before + 1
    back = stored.where("shipment_id = 'S5'").first()
    assert back.order_id == "O5" and back.otif_compliance_flag == 1 and str(back.order_day) == "2024-03-03"
    # Once more: it is no longer there to be let go.
    assert medallion.resubmit(spark, lake, "shipments", mended) == 0
    assert read_table(spark, f"{lake.silver}/shipments", merge_schema=True).count() == before + 1
    medallion.build_gold(spark, lake, export=False)
    gold = read_table(spark, f"{lake.gold}/gold_carrier_scorecard")
    assert values(gold, "carrier_id", "total_shipments") == [("C1", 4), ("C2", 2)]


def test_mended_telematics(spark, two_landings):
    lake, _, _ = two_landings
    path = f"{lake.silver}/fleet_telematics_quarantine"
    row = read_refused(spark, path).first()
    mended = spark.createDataFrame(
        [(row[ROW_ID], "2024-03-01T06:00:00Z")], f"{ROW_ID} string, timestamp string"
    )
    assert medallion.resubmit(spark, lake, "fleet_telematics", mended) == 1
    assert read_refused(spark, path).count() == 1
    fleet = read_table(spark, f"{lake.silver}/fleet_telematics")
    assert values(fleet, "telematics_id") == [("T1",), ("T2",)]
    twice = mended.unionByName(mended.selectExpr(ROW_ID, "'2024-04-01' AS timestamp"))
    with pytest.raises(Exception, match="conflicting rows"):
        other = read_refused(spark, path).first()[ROW_ID]
        medallion.resubmit(
            spark, lake, "fleet_telematics", twice.withColumn(ROW_ID, F.lit(other))
        )


def test_the_same_files_are_the_same_landing(spark, tmp_path):
    folder = tmp_path / "a b%20c+é"
    folder.mkdir()
    (folder / "x y.csv").write_text("carrier_id\nC1\n")
    first = landing_id(spark, str(folder))
    assert landing_id(spark, str(folder)) == first
    assert values(read_csv_text(spark, str(folder)), "carrier_id") == [("C1",)]
    (folder / "z.csv").write_text("carrier_id\nC2\n")
    assert landing_id(spark, str(folder)) != first


def test_gold_needs_a_star(spark, tmp_path):
    with pytest.raises(ValueError, match="star schema"):
        medallion.build_gold(spark, medallion.Lake(str(tmp_path)))


def grow(raw, name, file, text):
    kind = "json" if name == "fleet_telematics" else "csv"
    folder = raw / f"{name}.{kind}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / file).write_text(text)


def bronze_ids(spark, lake, name="shipments", column="shipment_id"):
    return [r[0] for r in values(read_table(spark, f"{lake.bronze}/{name}"), column)]


def test_each_file_lands_once(spark, tmp_path, monkeypatch):
    raw, lake = tmp_path / "raw", medallion.Lake(f"{tmp_path}/lake")
    for name, text in (("carriers", CARRIERS_CSV), ("warehouses", WAREHOUSES_CSV),
                       ("suppliers", SUPPLIERS_CSV)):
        grow(raw, name, "a.csv", text)
    grow(raw, "fleet_telematics", "a.json", "\n".join(json.dumps(r) for r in FLEET))
    grow(raw, "shipments", "a b.csv", "\n".join([SHIPMENT_HEADER, *FIRST]))
    incremental.run(spark, str(raw), lake.root, "2024-03-01")
    assert bronze_ids(spark, lake) == ["S1", "S2", "S3", "S4", "S5", "S6"]

    # Two more files; Bronze breaks off behind its first write.
    grow(raw, "shipments", "b.csv", "\n".join([SHIPMENT_HEADER, *SECOND]))
    grow(raw, "carriers", "b.csv", ONLY_C1.replace("One", "Uno"))
    write = incremental.overwrite_table

    def broken(frame, path):
        write(frame, path)
        if "bronze/shipments" in path:
            raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(incremental, "overwrite_table", broken)
        with pytest.raises(Exception, match="lost"):
            incremental.run(spark, str(raw), lake.root, "2024-03-02")
    # Then Silver breaks off between two feeds.
    take = incremental.take_landing

    def stops(spark, lake, name, landing):
        if name == "shipments":
            raise OSError("stopped")
        take(spark, lake, name, landing)

    with monkeypatch.context() as patch:
        patch.setattr(incremental, "take_landing", stops)
        with pytest.raises(OSError, match="stopped"):
            incremental.run(spark, str(raw), lake.root, "2024-03-02")
    landings = list_folders(spark, f"{lake.bronze}/shipments")
    assert incremental.waiting_landings(spark, lake, "shipments") == ["batch-000000001"]
    assert incremental.waiting_landings(spark, lake, "carriers") == []
    for _ in range(2):
        incremental.run(spark, str(raw), lake.root, "2024-03-02")
        assert list_folders(spark, f"{lake.bronze}/shipments") == landings
        assert sorted(bronze_ids(spark, lake)) == [
            "S1", "S2", "S3", "S3", "S4", "S5", "S6", "S7", "S8"
        ]
        gold = read_table(spark, f"{lake.gold}/gold_carrier_scorecard")
        assert values(gold, "carrier_id", "carrier_name", "total_shipments") == [
            ("C1", "Uno", 3), ("C2", "Two", 2),
        ]
        waiting = read_refused(spark, f"{lake.silver}/shipments_quarantine")
        assert values(waiting, "shipment_id") == [("S5",), ("S6",), ("S8",)]
        assert values(read_table(spark, f"{lake.silver}/fleet_telematics"), "telematics_id") == [
            ("T1",)
        ]
    assert land_again(spark, raw, lake) == []


def land_again(spark, raw, lake):
    return [x for new in incremental.land_new_files(spark, str(raw), lake).values() for x in new]


def test_files_of_a_landing_can_be_bounded(spark, tmp_path):
    raw, lake = tmp_path / "raw", medallion.Lake(f"{tmp_path}/lake")
    for k in range(5):
        grow(raw, "carriers", f"{k}.csv", f"carrier_id\nC{k}\n")
    landed = incremental.land_feed(spark, str(raw), lake, "carriers", files_per_landing=2)
    assert landed == ["batch-000000000", "batch-000000001", "batch-000000002"]
    assert bronze_ids(spark, lake, "carriers", "carrier_id") == [f"C{k}" for k in range(5)]
    assert incremental.land_feed(spark, str(raw), lake, "carriers") == []
