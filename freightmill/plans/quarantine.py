"""Refused rows: kept for every landing until they are mended.

A quarantine is a table laid out by landing. Landing the same files again replaces that
landing's rows, any other landing adds to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightmill.operators.upsert import distinct_by_key
from freightmill.sources.files import LANDING
from freightmill.sources.lake import (
    delete_folder,
    list_folders,
    overwrite_partitioned,
    overwrite_table,
    read_table,
)

ROW_ID, REASON = "_row_id", "_reason"
#: Columns that say how a row came, not what it holds.
PASSING = ("_ingested_at", REASON)


def with_row_id(refused: DataFrame) -> DataFrame:
    """A digest of a row's landing and content; rows that are alike in both share it."""
    content = [c for c in sorted(refused.columns) if c not in PASSING]
    told = F.to_json(F.struct(*[F.col(f"`{c}`") for c in content]))
    return refused.withColumn(ROW_ID, F.sha2(told, 256))


def add_refused(refused: DataFrame, path: str) -> None:
    """Store the refused rows of a landing beside those of earlier ones."""
    overwrite_partitioned(with_row_id(refused), path, LANDING)


def read_refused(spark: SparkSession, path: str) -> DataFrame | None:
    """All refused rows that wait for repair; None where no row was ever refused."""
    return read_table(spark, path, merge_schema=True) if list_folders(spark, path) else None


def repaired(waiting: DataFrame | None, mended: DataFrame) -> DataFrame:
    """The waiting rows that ``mended`` names, with its values in the place of theirs."""
    values = [c for c in mended.columns if c != ROW_ID]
    if waiting is None:
        return mended.limit(0).withColumn("_corrupt_record", F.lit(None).cast("string"))
    fixes = distinct_by_key(mended, ROW_ID, mended.columns)
    fixes = fixes.select(ROW_ID, *[F.col(c).cast("string").alias(f"_mended_{c}") for c in values])
    # A row that was broken as a whole is told anew by its columns.
    told = waiting.drop(REASON, "_corrupt_record", "_flaw").dropDuplicates([ROW_ID])
    rows = told.join(fixes, ROW_ID)
    settled = [F.col(f"_mended_{c}").alias(c) for c in values]
    return rows.select(*[c for c in told.columns if c not in values], *settled)


def release(spark: SparkSession, path: str, gone: DataFrame) -> int:
    """Take rows out of a quarantine by their id; returns how many ids left it."""
    waiting = read_refused(spark, path)
    if waiting is None:
        return 0
    leaving = waiting.join(gone, ROW_ID, "left_semi").select(LANDING, ROW_ID).distinct()
    counts = {r[LANDING]: r["count"] for r in leaving.groupBy(LANDING).count().collect()}
    # One round for each landing that mended rows came from.
    for landing in counts:
        folder = f"{path}/{LANDING}={landing}"
        rest = read_table(spark, folder).join(gone, ROW_ID, "left_anti")
        overwrite_table(rest, f"{path}_rest")
        overwrite_table(read_table(spark, f"{path}_rest"), folder)
        delete_folder(spark, f"{path}_rest")
    return sum(counts.values())
