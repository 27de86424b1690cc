"""Loading the star schema from Silver: dimensions by upsert, the fact by day.

A dimension is stored in buckets of its key. A load finds the rows that are new or changed by
their digests and rewrites the buckets these fall into; its manifest names, for every bucket,
the load that wrote it, so all others are carried over without being touched. Changed buckets,
manifest and the day of the fact go to folders of the load's own and, when everything is there,
one line is added to the load log. Readers go by the log, dimensions by the manifest of its
newest line and each day of the fact by the newest line of that day, so a load that fails
anywhere leaves everything as it was. ``retire_loads`` removes what no reader can reach.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightmill.contracts import DIM_CARRIER, DIM_SUPPLIER, DIM_WAREHOUSE, Contract
from freightmill.operators.batch_replace import day_batch, day_path, load_day
from freightmill.operators.upsert import (
    assign_surrogates,
    changed_rows,
    distinct_by_key,
    key_bucket,
    row_digest,
    upsert,
)
from freightmill.plans.calendar import dim_date
from freightmill.sources.evolution import noted_schema
from freightmill.sources.lake import (
    delete_folder,
    list_folders,
    overwrite_partitioned,
    overwrite_table,
    read_table,
)

FACT_TABLE = "fact_shipment_fulfillment"
SNAPSHOTS = "snapshots"
DIMENSION_BUCKETS = "dimensions"
MANIFESTS = "manifests"
#: Buckets of a dimension that is loaded for the first time.
BUCKETS = 32
BUCKET, DIGEST = "bucket", "_row_digest"
MANIFEST_SCHEMA = (
    "table_name STRING, bucket INT, buckets INT, load STRING, row_count BIGINT, top_key INT"
)
LOAD_LOG = "loads"
LOG_SCHEMA = "load_id STRING, batch_day DATE, published_at TIMESTAMP"


@dataclass(frozen=True)
class DimensionLoad:
    contract: Contract
    silver: str
    key: str
    surrogate: str

    @property
    def table(self) -> str:
        return self.contract.name

    @property
    def warehouse_defaults(self) -> dict[str, Column]:
        """Columns the silver table does not have; kept on update, set on insert."""
        known = set(self.contract.columns)
        every = {"effective_start_date": F.localtimestamp(), "is_active": F.lit(1)}
        return {c: v for c, v in every.items() if c in known}

    @property
    def loaded_columns(self) -> list[str]:
        return [c for c in self.contract.columns if c not in self.warehouse_defaults]


DIMENSIONS = (
    DimensionLoad(DIM_CARRIER, "carriers", "carrier_id", "carrier_key"),
    DimensionLoad(DIM_WAREHOUSE, "warehouses", "warehouse_id", "warehouse_key"),
    DimensionLoad(DIM_SUPPLIER, "suppliers", "supplier_id", "supplier_key"),
)


def batch_day(batch_date: date | str | None) -> date:
    """The requested day, or today (UTC) when none is given."""
    if batch_date is None:
        return datetime.now(timezone.utc).date()
    return date.fromisoformat(batch_date) if isinstance(batch_date, str) else batch_date


def _load_log(spark: SparkSession, path: str) -> DataFrame | None:
    """The log, or None before any load wrote one. The schema is declared, so a folder
    left empty by a cut-short write reads as an empty log."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _empty_dimension(spark: SparkSession, load: DimensionLoad) -> DataFrame:
    fields = [T.StructField(load.surrogate, T.IntegerType()), *load.contract.struct.fields]
    return spark.createDataFrame([], T.StructType([*fields, T.StructField(DIGEST, T.StringType())]))


def _manifest(spark: SparkSession, star_dir: str, load_id: str | None, table: str) -> list[Row]:
    """One row for each stored bucket of a dimension: never more than it has buckets."""
    if load_id is None:
        return []
    manifest = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{star_dir}/{MANIFESTS}/{load_id}")
    return manifest.filter(F.col("table_name") == table).collect()


def _stored_buckets(
    spark: SparkSession, star_dir: str, load: DimensionLoad, buckets: list[Row]
) -> DataFrame:
    """The rows of some buckets, with their digests."""
    base = f"{star_dir}/{DIMENSION_BUCKETS}/{load.table}"
    paths = [f"{base}/load={b['load']}/{BUCKET}={b['bucket']}" for b in buckets]
    if not paths:
        return _empty_dimension(spark, load)
    return spark.read.option("mergeSchema", True).parquet(*paths)


def load_dimension(
    spark: SparkSession,
    star_dir: str,
    load: DimensionLoad,
    silver: DataFrame,
    load_id: str,
    buckets: int = BUCKETS,
) -> list[Row]:
    """Write the buckets of a dimension that ``silver`` changes; returns its new manifest.

    Nothing that is published changes. A silver table with conflicting rows for a key fails.
    """
    before = _manifest(spark, star_dir, published_load(spark, star_dir), load.table)
    buckets = before[0]["buckets"] if before else buckets
    aside = f"{star_dir}/{SNAPSHOTS}/{load_id}/{load.table}"
    source = distinct_by_key(silver, load.key, load.loaded_columns).withColumns(
        {DIGEST: row_digest(load.loaded_columns), BUCKET: key_bucket(load.key, buckets)}
    )
    overwrite_table(source, f"{aside}_incoming")
    incoming = read_table(spark, f"{aside}_incoming")
    stored = _stored_buckets(spark, star_dir, load, before)
    changed = changed_rows(incoming, stored, load.key, DIGEST).select(BUCKET).distinct()
    touched = {r[0] for r in changed.collect()}
    kept = [b for b in before if b["bucket"] not in touched]
    written: list[Row] = []
    if touched:
        target = _stored_buckets(
            spark, star_dir, load, [b for b in before if b["bucket"] in touched]
        )
        # Columns of an earlier contract stay, columns that are new to it start as NULL.
        lacking = [c for c in _empty_dimension(spark, load).schema if c.name not in target.columns]
        target = target.withColumns({c.name: F.lit(None).cast(c.dataType) for c in lacking})
        rows = incoming.filter(F.col(BUCKET).isin(sorted(touched)))
        snapshot = upsert(
            target, rows, load.key, [*load.loaded_columns, DIGEST], load.warehouse_defaults
        )
        # The upsert is written before keys are assigned, so numbering reads a settled table.
        overwrite_table(snapshot, f"{aside}_merged")
        taken = max((b["top_key"] or 0 for b in before), default=0)
        numbered = assign_surrogates(
            read_table(spark, f"{aside}_merged"), load.key, load.surrogate, F.lit(taken)
        )
        place = f"{star_dir}/{DIMENSION_BUCKETS}/{load.table}/load={load_id}"
        overwrite_partitioned(
            numbered.withColumn(BUCKET, key_bucket(load.key, buckets)), place, BUCKET, True
        )
        written = (
            read_table(spark, place)
            .groupBy(F.col(BUCKET).cast("int").alias(BUCKET))
            .agg(F.count("*").alias("row_count"), F.max(load.surrogate).alias("top_key"))
            .select(
                F.lit(load.table).alias("table_name"),
                BUCKET,
                F.lit(buckets).alias("buckets"),
                F.lit(load_id).alias("load"),
                "row_count",
                "top_key",
            )
            .collect()
        )
        delete_folder(spark, f"{aside}_merged")
    delete_folder(spark, f"{aside}_incoming")
    return kept + written


def calendar_span(batch: DataFrame, calendar: DataFrame | None) -> DataFrame:
    """First and last day of the batch's orders and deliveries and of the days already there.

    Only the batch is read, never the whole fact.
    """
    days = batch.select(
        F.expr(
            "explode(array(CAST(order_date AS DATE), promised_delivery_date, actual_delivery_date))"
        ).alias("full_date")
    )
    if calendar is not None:
        days = days.unionByName(calendar.select("full_date"))
    return days.agg(F.min("full_date").alias("first_day"), F.max("full_date").alias("last_day"))


def published_load(spark: SparkSession, star_dir: str) -> str | None:
    """Id of the newest complete load: one value from the load log."""
    log = _load_log(spark, f"{star_dir}/{LOAD_LOG}")
    return None if log is None else log.agg(F.max_by("load_id", "published_at")).first()[0]


def read_dimension(spark: SparkSession, star_dir: str, table: str) -> DataFrame | None:
    """A dimension as of the newest complete load; None before the first one."""
    load_id = published_load(spark, star_dir)
    if load_id is None:
        return None
    for load in DIMENSIONS:
        if load.table == table:
            buckets = _manifest(spark, star_dir, load_id, table)
            return _stored_buckets(spark, star_dir, load, buckets).drop(DIGEST)
    return read_table(spark, f"{star_dir}/{SNAPSHOTS}/{load_id}/{table}")


def _published_days(spark: SparkSession, star_dir: str) -> dict[date, str]:
    """Day -> newest complete load of it: one log line for each day that was ever loaded."""
    log = _load_log(spark, f"{star_dir}/{LOAD_LOG}")
    if log is None:
        return {}
    newest = log.groupBy("batch_day").agg(F.max_by("load_id", "published_at").alias("load_id"))
    return {r["batch_day"]: r["load_id"] for r in newest.collect()}


def read_fact(spark: SparkSession, star_dir: str) -> DataFrame | None:
    """The fact with all its published days; None before the first load."""
    fact = f"{star_dir}/{FACT_TABLE}"
    paths = [day_path(fact, load, day) for day, load in _published_days(spark, star_dir).items()]
    if not paths:
        return None
    # The schema was noted by the loads, so no footer is read for it.
    schema = noted_schema(spark, fact)
    return spark.read.option("basePath", fact).schema(schema).parquet(*paths).drop("load")


def retire_loads(spark: SparkSession, star_dir: str) -> list[str]:
    """Remove the folders of loads that were cut short or superseded; returns their ids.

    Run it while no load is running: a load that has not reached the log looks like one that
    never will.
    """
    days = set(_published_days(spark, star_dir).values())
    newest = published_load(spark, star_dir)
    retired = set()
    for kind in (SNAPSHOTS, MANIFESTS):
        for load_id in list_folders(spark, f"{star_dir}/{kind}"):
            if load_id != newest:
                delete_folder(spark, f"{star_dir}/{kind}/{load_id}")
                retired.add(load_id)
    in_use = {FACT_TABLE: days}
    for load in DIMENSIONS:
        buckets = _manifest(spark, star_dir, newest, load.table)
        in_use[f"{DIMENSION_BUCKETS}/{load.table}"] = {b["load"] for b in buckets}
    for table, loads in in_use.items():
        for folder in list_folders(spark, f"{star_dir}/{table}"):
            load_id = folder.removeprefix("load=")
            if load_id not in loads:
                delete_folder(spark, f"{star_dir}/{table}/{folder}")
                retired.add(load_id)
    return sorted(retired)


def load_star(
    spark: SparkSession, silver_dir: str, star_dir: str, batch_date: date | str | None = None
) -> str:
    """Load one order day and the dimensions; returns the id of the load."""
    day = batch_day(batch_date)
    load_id = f"{day.isoformat()}-{uuid.uuid4().hex[:12]}"
    fresh = f"{star_dir}/{SNAPSHOTS}/{load_id}"

    manifest = [
        line
        for load in DIMENSIONS
        for line in load_dimension(
            spark, star_dir, load, read_table(spark, f"{silver_dir}/{load.silver}"), load_id
        )
    ]
    lines = spark.createDataFrame([tuple(line) for line in manifest], MANIFEST_SCHEMA)
    overwrite_table(lines.coalesce(1), f"{star_dir}/{MANIFESTS}/{load_id}")

    silver_shipments = read_table(spark, f"{silver_dir}/shipments")
    load_day(day_batch(silver_shipments, day), f"{star_dir}/{FACT_TABLE}", load_id, day)
    batch = read_table(spark, day_path(f"{star_dir}/{FACT_TABLE}", load_id, day))
    calendar = dim_date(calendar_span(batch, read_dimension(spark, star_dir, "dim_date")))
    overwrite_table(calendar, f"{fresh}/dim_date")

    record = spark.range(1).select(
        F.lit(load_id).alias("load_id"),
        F.lit(day).alias("batch_day"),
        F.current_timestamp().alias("published_at"),
    )
    record.coalesce(1).write.mode("append").parquet(f"{star_dir}/{LOAD_LOG}")
    return load_id
