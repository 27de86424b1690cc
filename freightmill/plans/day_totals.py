"""The stored day totals that Gold is summed from.

Each grain is a table laid out by order day. Before shipments of a day change, the day is noted;
a refresh tallies the noted days again, puts their totals in place of the old ones and only then
strikes the notes out. A job that stops anywhere leaves notes behind, never stale totals unseen.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightmill.operators.batch_replace import DAY_PARTITION
from freightmill.operators.day_tally import GRAINS, day_tally, on_days
from freightmill.sources.lake import (
    delete_folder,
    list_folders,
    overwrite_partitioned,
    overwrite_table,
    read_table,
)

NOTES = "out_of_date"


def note_days(spark: SparkSession, folder: str, days: list[date | None]) -> None:
    """Note that the totals of ``days`` will be out of date."""
    rows = spark.createDataFrame([(d,) for d in days], f"{DAY_PARTITION} date")
    overwrite_table(rows.coalesce(1), f"{folder}/{NOTES}/{uuid.uuid4().hex}")


def refresh_totals(spark: SparkSession, fact_path: str, folder: str) -> list[date | None] | None:
    """Tally the noted days again, all days where no totals are stored yet.

    Returns the days tallied, None for all of them. Only their folders of the fact are read.
    """
    notes = list_folders(spark, f"{folder}/{NOTES}")
    noted: set[date | None] = set()
    for note in notes:
        noted |= {r[0] for r in read_table(spark, f"{folder}/{NOTES}/{note}").collect()}
    fact = read_table(spark, fact_path, merge_schema=True)
    started = all(list_folders(spark, f"{folder}/{grain}") for grain in GRAINS)
    days = sorted(noted, key=str) if started else None
    if days is None or days:
        shipments = stale_shipments(fact, days)
        for grain in GRAINS:
            overwrite_partitioned(
                day_tally(shipments, grain), f"{folder}/{grain}", DAY_PARTITION, days is None
            )
    for note in notes:
        delete_folder(spark, f"{folder}/{NOTES}/{note}")
    return days


def stale_shipments(fact: DataFrame, days: list[date | None] | None) -> DataFrame:
    """The shipments a refresh reads: those of ``days``, all for None."""
    return fact if days is None else fact.filter(on_days(fact, days))


def read_totals(spark: SparkSession, folder: str, grain: str) -> DataFrame:
    """Totals by order day and the keys of the grain."""
    totals = read_table(spark, f"{folder}/{grain}")
    return totals.withColumn(DAY_PARTITION, F.col(DAY_PARTITION).cast("date"))
