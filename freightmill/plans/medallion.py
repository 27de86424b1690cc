"""The batch job: landing files to Bronze, Silver, Gold and the star schema."""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightmill.contracts import FEEDS
from freightmill.operators.day_tally import GRAINS, on_days, over_days
from freightmill.operators.enrich import (
    enrich_carriers,
    enrich_shipments,
    enrich_suppliers,
    enrich_warehouses,
    split_feed,
)
from freightmill.plans.day_totals import note_days, read_totals, refresh_totals
from freightmill.plans.gold import (
    agg_carrier_scorecard,
    carrier_sheet,
    supplier_sheet,
    warehouse_sheet,
)
from freightmill.plans.quarantine import (
    ROW_ID,
    add_refused,
    read_refused,
    release,
    repaired,
)
from freightmill.plans.star import load_star, published_load, read_dimension
from freightmill.plans.summary import summary_parts, write_summary
from freightmill.session import build_session
from freightmill.sources.files import read_landing
from freightmill.sources.lake import (
    delete_folder,
    folder_exists,
    list_folders,
    overwrite_partitioned,
    overwrite_table,
    read_table,
    replace_catalog_table,
    write_csv,
)


@dataclass(frozen=True)
class Lake:
    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    @property
    def star(self) -> str:
        return f"{self.root}/star"

    @property
    def totals(self) -> str:
        return f"{self.root}/totals"

    @property
    def export(self) -> str:
        return f"{self.root}/export"


def ingest_bronze(
    spark: SparkSession,
    raw_dir: str,
    lake: Lake,
    array_document: bool = True,
    multi_line: bool = False,
) -> None:
    """The landing as it came: every value in text, unknown JSON fields and broken records too."""
    for name, feed in read_landing(spark, raw_dir, array_document, multi_line).items():
        overwrite_table(feed, f"{lake.bronze}/{name}")


def silver_tables(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Typed and enriched feeds, and for each the rows that were refused, raw and with a reason."""
    good, refused = {}, {}
    for name, contract in FEEDS.items():
        good[name], refused[f"{name}_quarantine"] = split_feed(bronze[name], contract)
    return {
        **{name: enrich_feed(name, rows) for name, rows in good.items()},
        **refused,
    }


def enrich_feed(name: str, good: DataFrame) -> DataFrame:
    """Good rows of a feed as its Silver table holds them."""
    if name == "shipments":
        return enrich_shipments(good).withColumn("order_day", F.col("order_date").cast("date"))
    if name == "carriers":
        return enrich_carriers(good)
    if name == "warehouses":
        return enrich_warehouses(good)
    return enrich_suppliers(good) if name == "suppliers" else good


def merge_days(
    new: DataFrame,
    path: str,
    key: str,
    partition: str,
    announce: Callable[[list[date | None]], None] | None = None,
) -> list[date | None]:
    """Add a landing to a table laid out by day; returns the days it touched.

    Of rows with the same key in the same day the landing's count, other days and other rows
    stay, and only the landing's days are read. The merged days are written aside first, so a
    failed write leaves the table as it was. ``announce`` hears of the days before the table
    changes.
    """
    spark = new.sparkSession
    fresh, aside = f"{path}_landed", f"{path}_merging"
    overwrite_table(new, fresh)
    landed = read_table(spark, fresh)
    # One value for each day of the landing.
    days = [r[0] for r in landed.select(partition).distinct().collect()]
    merged = landed
    if list_folders(spark, path):
        stored = read_table(spark, path, merge_schema=True)
        replaced = landed.select(F.col(partition).alias("_day"), F.col(key).alias("_key"))
        same_row = F.col(partition).eqNullSafe(F.col("_day")) & (F.col(key) == F.col("_key"))
        kept = stored.filter(on_days(stored, days)).join(replaced.distinct(), same_row, "left_anti")
        merged = kept.unionByName(landed, allowMissingColumns=True)
    overwrite_table(merged, aside)
    if announce:
        announce(days)
    overwrite_partitioned(read_table(spark, aside), path, partition)
    delete_folder(spark, aside)
    delete_folder(spark, fresh)
    return days


def add_shipments(lake: Lake, table: DataFrame) -> None:
    """Merge shipments into Silver and note the days whose totals are out of date by it."""
    merge_days(
        table,
        f"{lake.silver}/shipments",
        "shipment_id",
        "order_day",
        lambda days: note_days(table.sparkSession, lake.totals, days),
    )


def process_silver(spark: SparkSession, lake: Lake) -> None:
    """Shipments are laid out by order day, the column every batch selects on, and keep all
    earlier landings, as the quarantines do; the other tables are the current landing's."""
    bronze = {name: read_table(spark, f"{lake.bronze}/{name}") for name in FEEDS}
    for name, table in silver_tables(bronze).items():
        if name == "shipments":
            add_shipments(lake, table)
        elif name.endswith("_quarantine"):
            add_refused(table, f"{lake.silver}/{name}")
        else:
            overwrite_table(table, f"{lake.silver}/{name}")


def resubmit(spark: SparkSession, lake: Lake, feed: str, mended: DataFrame) -> int:
    """Bring mended rows of a quarantine back; returns how many rows it let go.

    ``mended`` has ``_row_id`` and, as text, the columns of the feed that were mended; what it
    does not name stays as it landed. A row that is good now is merged into the feed's Silver
    table and then leaves the quarantine; one that is still refused stays there as it was. Rows
    that are not in the quarantine (any more) are passed over, so sending a repair again changes
    nothing, and one cut short can simply be sent again. Gold takes note at its next build.
    """
    contract, path = FEEDS[feed], f"{lake.silver}/{feed}_quarantine"
    waiting = repaired(read_refused(spark, path), mended)
    good, _ = split_feed(waiting, contract)
    aside = f"{path}_mended"
    overwrite_table(good, aside)
    settled = read_table(spark, aside)
    rows = enrich_feed(feed, settled.drop(ROW_ID))
    if feed == "shipments":
        add_shipments(lake, rows)
    else:
        merge_keys(rows, f"{lake.silver}/{feed}", contract.unique[0][0])
    gone = settled.select(ROW_ID).distinct()
    count = release(spark, path, gone)
    delete_folder(spark, aside)
    return count


def merge_keys(new: DataFrame, path: str, key: str) -> None:
    """Put rows into a table, in the place of those with the same key."""
    spark = new.sparkSession
    merged = new
    if folder_exists(spark, path):
        stored = read_table(spark, path)
        kept = stored.join(new.select(key).distinct(), key, "left_anti")
        merged = kept.unionByName(new, allowMissingColumns=True)
    overwrite_table(merged, f"{path}_merging")
    overwrite_table(read_table(spark, f"{path}_merging"), path)
    delete_folder(spark, f"{path}_merging")


GOLD_TABLES = ("gold_carrier_scorecard", "gold_warehouse_monthly", "gold_supplier_reliability")


def gold_tables(
    totals: dict[str, DataFrame], dimensions: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """Gold from totals by grain and the dimensions they are described by."""
    return {
        "gold_carrier_scorecard": carrier_sheet(totals["carrier"], dimensions["dim_carrier"]),
        "gold_warehouse_monthly": warehouse_sheet(
            totals["warehouse"], dimensions["dim_warehouse"]
        ),
        "gold_supplier_reliability": supplier_sheet(
            totals["supplier"], dimensions["dim_supplier"]
        ),
    }


def build_gold(spark: SparkSession, lake: Lake, export: bool = True) -> None:
    """Gold tables, then (``export``) their CSV and JSON copies and a CSV of the shipments.

    Totals are kept by order day; only days that shipments were added to since the last build
    are read again. Names and targets come from the star's dimensions, which keep what earlier
    landings had, so history stays whole when a feed no longer lists an entity.
    """
    if published_load(spark, lake.star) is None:
        raise ValueError(f"Gold needs the dimensions of a loaded star schema: {lake.star}")
    refresh_totals(spark, f"{lake.silver}/shipments", lake.totals)
    totals = {
        grain: over_days(read_totals(spark, lake.totals, grain), *GRAINS[grain])
        for grain in ("carrier", "warehouse", "supplier", "reason")
    }
    dimensions = {
        name: read_dimension(spark, lake.star, name)
        for name in ("dim_carrier", "dim_warehouse", "dim_supplier")
    }
    for name, table in gold_tables(totals, dimensions).items():
        overwrite_table(table, f"{lake.gold}/{name}")
    gold = {name: read_table(spark, f"{lake.gold}/{name}") for name in GOLD_TABLES}
    overwrite_table(
        agg_carrier_scorecard(gold["gold_carrier_scorecard"]), f"{lake.gold}/agg_carrier_scorecard"
    )
    if not export:
        return
    for name, table in gold.items():
        write_csv(table, f"{lake.export}/{name}")
    names = ("shipments", "warehouses", "suppliers")
    silver = {name: read_table(spark, f"{lake.silver}/{name}") for name in names}
    write_csv(silver["shipments"].drop("_unreadable_columns"), f"{lake.export}/silver_shipments")
    parts = summary_parts(totals["reason"], silver["warehouses"], silver["suppliers"], gold)
    write_summary(parts, f"{lake.export}/summary")


# Catalog table name -> (layer, table) it replaces.
CATALOG_TABLES = {
    "dim_carrier": ("silver", "carriers"),
    "dim_warehouse": ("silver", "warehouses"),
    "dim_supplier": ("silver", "suppliers"),
    "fact_shipment_fulfillment": ("silver", "shipments"),
    "fact_fleet_telematics": ("silver", "fleet_telematics"),
    "gold_carrier_scorecard": ("gold", "gold_carrier_scorecard"),
    "gold_warehouse_monthly": ("gold", "gold_warehouse_monthly"),
    "gold_supplier_reliability": ("gold", "gold_supplier_reliability"),
}


def publish_catalog(spark: SparkSession, lake: Lake, database: str = "default") -> None:
    """Replace the reporting tables of a catalog database."""
    for name, (layer, table) in CATALOG_TABLES.items():
        stored = read_table(spark, f"{lake.root}/{layer}/{table}")
        partition = "order_day" if "order_day" in stored.columns else None
        replace_catalog_table(stored, f"{database}.{name}", partition)


def run(
    spark: SparkSession,
    raw_dir: str,
    lake_dir: str,
    batch_date: date | str | None = None,
    array_document: bool = True,
    export: bool = True,
    multi_line: bool = False,
    catalog: str | None = None,
) -> Lake:
    """Raw files to published star schema for one batch day (today when none is given).

    Gold covers every landing so far, and every carrier, warehouse and supplier that any of them
    listed. ``catalog`` names a database whose reporting tables are
    replaced at the end.
    """
    lake = Lake(lake_dir)
    ingest_bronze(spark, raw_dir, lake, array_document, multi_line)
    process_silver(spark, lake)
    load_star(spark, lake.silver, lake.star, batch_date)
    build_gold(spark, lake, export)
    if catalog:
        publish_catalog(spark, lake, catalog)
    return lake


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("raw_dir")
    parser.add_argument("lake_dir")
    parser.add_argument("--batch-date", help="yyyy-mm-dd; today when left out")
    parser.add_argument(
        "--environment", default="prod", help="name shown in the Spark application"
    )
    parser.add_argument(
        "--json-lines", action="store_true", help="telematics is one record per line"
    )
    parser.add_argument("--no-export", action="store_true", help="skip the CSV and JSON copies")
    parser.add_argument(
        "--multi-line", action="store_true", help="CSV values may hold line breaks in quotes"
    )
    parser.add_argument("--catalog", help="database whose reporting tables are replaced")
    args = parser.parse_args()
    spark = build_session(f"freightmill-{args.environment}")
    run(
        spark,
        args.raw_dir,
        args.lake_dir,
        args.batch_date,
        array_document=not args.json_lines,
        export=not args.no_export,
        multi_line=args.multi_line,
        catalog=args.catalog,
    )


if __name__ == "__main__":
    main()
