"""Idempotent load of one order day into the shipment fact."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightmill.contracts import FACT_SHIPMENT
from freightmill.sources.evolution import check_batch, note_schema

DAY_PARTITION = "order_day"


def order_day(frame: DataFrame) -> Column:
    """The stored day where the table is laid out by it, so that other days are pruned."""
    if DAY_PARTITION in frame.columns:
        return F.col(DAY_PARTITION).cast("date")
    return F.col("order_date").cast("date")


def fact_rows(silver_shipments: DataFrame) -> DataFrame:
    """The 21 load columns, in contract order and type."""
    return silver_shipments.select(
        *[F.col(a.name).cast(a.dtype).alias(a.name) for a in FACT_SHIPMENT.attributes]
    )


def day_batch(silver_shipments: DataFrame, batch_date: date) -> DataFrame:
    return fact_rows(silver_shipments.filter(order_day(silver_shipments) == F.lit(batch_date)))


def replace_day(target: DataFrame, staging: DataFrame, batch_date: date) -> DataFrame:
    """The fact after delete-and-insert of one day, as a plan.

    Rows without an order date match no day, so the delete leaves them alone.
    """
    other_days = target.filter(~order_day(target).eqNullSafe(F.lit(batch_date)))
    return other_days.unionByName(day_batch(staging, batch_date))


def day_path(fact_path: str, load_id: str, batch_date: date) -> str:
    return f"{fact_path}/load={load_id}/{DAY_PARTITION}={batch_date.isoformat()}"


def load_day(batch: DataFrame, fact_path: str, load_id: str, batch_date: date) -> None:
    """Write one day of one load to a folder of its own.

    Readers go by the load log, so the day of an earlier load stays what they see until this
    load is published, whatever happens to this write. An empty batch empties the day.
    """
    stamped = batch.withColumn("loaded_at", F.localtimestamp())
    check_batch(stamped, fact_path)
    (
        stamped.write.option("partitionOverwriteMode", "static")
        .mode("overwrite")
        .parquet(day_path(fact_path, load_id, batch_date))
    )
    note_schema(stamped, fact_path)
