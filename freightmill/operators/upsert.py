"""Dimension upserts on snapshot tables, and surrogate keys for the inserted rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed number of numbering groups: three hex digits of an MD5.
NUMBERING_DIGITS = 3


def distinct_by_key(source: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Distinct rows of ``columns`` (the key among them), failing the job when a
    key has two versions or is NULL.

    One pass with map-side combine: the smallest and the largest version of a key
    are the same row exactly when there is only one version.
    """
    version = F.struct(*[F.col(c) for c in columns])
    spread = source.groupBy(key).agg(F.min(version).alias("_lo"), F.max(version).alias("_hi"))
    complaint = F.concat(
        F.lit(f"upsert source: {key} is NULL or has conflicting rows: "),
        F.coalesce(F.col(key).cast("string"), F.lit("NULL")),
    )
    sound = F.col(key).isNotNull() & F.col("_lo").eqNullSafe(F.col("_hi"))
    checked = F.when(sound, F.col("_lo")).otherwise(
        F.raise_error(complaint).cast(spread.schema["_lo"].dataType)
    )
    return spread.select(checked.alias("_row")).select("_row.*")


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    columns: list[str],
    defaults: Mapping[str, Column] | None = None,
) -> DataFrame:
    """New snapshot of ``target``: update matches, insert new keys, keep the rest.

    ``columns`` are taken from the source whenever the key is in it, NULLs included.
    Other target columns keep their value on a match and get ``defaults`` (or NULL)
    on an insert.
    """
    defaults = defaults or {}
    incoming = distinct_by_key(source, key, columns).select(
        F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in columns]
    )
    merged = target.join(incoming, target[key] == F.col("_key"), "full_outer")
    in_source, in_target = F.col("_key").isNotNull(), F.col(key).isNotNull()

    def settle(name: str) -> Column:
        if name == key:
            return F.coalesce(F.col(key), F.col("_key")).alias(key)
        if name in columns:
            return F.when(in_source, F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name)
        if name in defaults:
            return F.when(in_target, F.col(name)).otherwise(defaults[name]).alias(name)
        return F.col(name)

    return merged.select(*[settle(c) for c in target.columns])


def row_digest(columns: list[str]) -> Column:
    """MD5 over the named columns; NULL, empty and joined values all differ."""
    told = F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"})
    return F.md5(told)


def key_bucket(key: str, buckets: int) -> Column:
    """Which of ``buckets`` storage buckets a business key belongs to."""
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def changed_rows(
    incoming: DataFrame, stored: DataFrame, key: str, digest: str
) -> DataFrame:
    """Rows of ``incoming`` that ``stored`` does not have, or has with another digest.

    Only the key and the digest of the stored rows are read.
    """
    known = stored.select(F.col(key).alias("_known_key"), F.col(digest).alias("_known_digest"))
    same = (F.col(key) == F.col("_known_key")) & (F.col(digest) == F.col("_known_digest"))
    return incoming.join(known, same, "left_anti")


def assign_surrogates(
    snapshot: DataFrame, business_key: str, surrogate: str, taken: Column | None = None
) -> DataFrame:
    """Give rows whose surrogate is NULL the next free numbers, without gaps.

    ``taken`` is the highest number in use, where ``snapshot`` is not the whole table.

    A single running number would sort all new rows in one task. Rows are instead
    numbered inside groups of an MD5 prefix; the groups' sizes (at most 4,096 rows,
    whatever the dimension's size) give each group its offset.
    """
    group = F.substring(F.md5(F.col(business_key).cast("string")), 1, NUMBERING_DIGITS)
    fresh = snapshot.filter(F.col(surrogate).isNull()).withColumn("_group", group)
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        fresh.groupBy("_group")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_group", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    if taken is None:
        taken = snapshot.agg(F.coalesce(F.max(surrogate), F.lit(0)).alias("top")).scalar()
    in_group = F.row_number().over(Window.partitionBy("_group").orderBy(business_key))
    kind = snapshot.schema[surrogate].dataType
    numbered = (
        fresh.withColumn("_nth", in_group)
        .join(F.broadcast(offsets), "_group")
        .withColumn(surrogate, (taken + F.col("_offset") + F.col("_nth")).cast(kind))
        .select(*snapshot.columns)
    )
    return snapshot.filter(F.col(surrogate).isNotNull()).unionByName(numbered)
