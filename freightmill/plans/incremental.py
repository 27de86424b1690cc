"""Landing folders that grow: every file is taken in once.

A file stream with its checkpoint finds the files of a feed that no run has seen, and a batch of
them is a landing. The stream plans a batch before it runs, so one that stopped is run again
with the same number and the same files, and writes the same Bronze folder again. Silver takes
landings in their order and notes each when it is done; what is not noted is taken again, which
changes nothing, since its merges go by key.

A landing folder holds one folder for each feed, named as the batch job's files. A file must
come under a name of its own and be complete when it appears; one that is written over is not
seen again. A lake is fed by this job or by the batch job, not by both in turn.
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightmill.contracts import FEEDS, TELEMATICS
from freightmill.operators.enrich import split_feed
from freightmill.plans.medallion import (
    Lake,
    add_shipments,
    build_gold,
    enrich_feed,
    merge_keys,
    publish_catalog,
)
from freightmill.plans.quarantine import add_refused
from freightmill.plans.star import load_star
from freightmill.session import build_session
from freightmill.sources.files import (
    LANDING,
    feed_path,
    read_csv_text,
    read_json_text,
    with_origin,
)
from freightmill.sources.lake import (
    list_folders,
    overwrite_partitioned,
    overwrite_table,
    read_table,
)

#: What Spark's reader of whole files tells about them; only the path is read here.
FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def _landing_name(batch: int) -> str:
    return f"batch-{batch:09d}"


def land_feed(
    spark: SparkSession,
    raw_dir: str,
    lake: Lake,
    name: str,
    array_document: bool = False,
    multi_line: bool = False,
    files_per_landing: int | None = None,
) -> list[str]:
    """Take in the files of one feed that are new; returns the landings they went to."""
    contract = FEEDS[name]
    landed: list[str] = []

    def land(files: DataFrame, batch: int) -> None:
        session = files.sparkSession
        # The names of the new files, which the driver needs to read them.
        paths = [r["path"] for r in files.select("path").collect()]
        if not paths:
            return
        if contract is TELEMATICS:
            feed = read_json_text(session, paths, contract, array_document)
        else:
            feed = read_csv_text(session, paths, multi_line)
        stamped = with_origin(feed, contract.source_system)
        overwrite_table(stamped, f"{lake.bronze}/{name}/{LANDING}={_landing_name(batch)}")
        landed.append(_landing_name(batch))

    source = spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
    source = source.option("recursiveFileLookup", True)
    if files_per_landing:
        source = source.option("maxFilesPerTrigger", files_per_landing)
    query = (
        source.load(feed_path(raw_dir, name))
        .select("path")
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", f"{lake.root}/checkpoints/{name}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return landed


def land_new_files(
    spark: SparkSession,
    raw_dir: str,
    lake: Lake,
    array_document: bool = False,
    multi_line: bool = False,
    files_per_landing: int | None = None,
) -> dict[str, list[str]]:
    """Take in what is new of all feeds; returns each feed's new landings."""
    options = (array_document, multi_line, files_per_landing)
    return {name: land_feed(spark, raw_dir, lake, name, *options) for name in FEEDS}


def waiting_landings(spark: SparkSession, lake: Lake, name: str) -> list[str]:
    """Landings of a feed that Silver has not taken yet, oldest first."""
    there = list_folders(spark, f"{lake.bronze}/{name}")
    landings = {f.removeprefix(f"{LANDING}=") for f in there if f.startswith(f"{LANDING}=")}
    return sorted(landings - set(list_folders(spark, f"{lake.root}/taken/{name}")))


def take_landing(spark: SparkSession, lake: Lake, name: str, landing: str) -> None:
    """Bring one landing of a feed into Silver and note it as taken."""
    contract = FEEDS[name]
    raw = read_table(spark, f"{lake.bronze}/{name}/{LANDING}={landing}").withColumn(
        LANDING, F.lit(landing)
    )
    good, refused = split_feed(raw, contract)
    rows, path = enrich_feed(name, good), f"{lake.silver}/{name}"
    if name == "shipments":
        add_shipments(lake, rows)
    elif contract is TELEMATICS:
        overwrite_partitioned(rows, path, LANDING)
    else:
        merge_keys(rows, path, contract.unique[0][0])
    add_refused(refused, f"{lake.silver}/{name}_quarantine")
    overwrite_table(spark.range(0), f"{lake.root}/taken/{name}/{landing}")


def run(
    spark: SparkSession,
    raw_dir: str,
    lake_dir: str,
    batch_date: date | str | None = None,
    array_document: bool = False,
    export: bool = False,
    multi_line: bool = False,
    catalog: str | None = None,
    files_per_landing: int | None = None,
) -> Lake:
    """New files to published star schema and Gold; see ``medallion.run`` for the rest."""
    lake = Lake(lake_dir)
    land_new_files(spark, raw_dir, lake, array_document, multi_line, files_per_landing)
    for name in FEEDS:
        for landing in waiting_landings(spark, lake, name):
            take_landing(spark, lake, name, landing)
    load_star(spark, lake.silver, lake.star, batch_date)
    build_gold(spark, lake, export)
    if catalog:
        publish_catalog(spark, lake, catalog)
    return lake


def main() -> None:
    parser = argparse.ArgumentParser(description="Take in the new files of a landing folder.")
    parser.add_argument("raw_dir")
    parser.add_argument("lake_dir")
    parser.add_argument("--batch-date", help="yyyy-mm-dd; today when left out")
    parser.add_argument("--environment", default="prod", help="name shown in the application")
    parser.add_argument("--json-array", action="store_true", help="telematics files are arrays")
    parser.add_argument("--multi-line", action="store_true", help="CSV values may hold line breaks")
    parser.add_argument("--export", action="store_true", help="write the CSV and JSON copies")
    parser.add_argument("--catalog", help="database whose reporting tables are replaced")
    parser.add_argument("--files-per-landing", type=int)
    args = parser.parse_args()
    run(
        build_session(f"freightmill-{args.environment}"),
        args.raw_dir,
        args.lake_dir,
        args.batch_date,
        array_document=args.json_array,
        export=args.export,
        multi_line=args.multi_line,
        catalog=args.catalog,
        files_per_landing=args.files_per_landing,
    )


if __name__ == "__main__":
    main()
