"""Lake tables (Parquet folders) and the other sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from freightmill.sources.evolution import check_batch, note_schema, read_evolving


def read_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """``merge_schema`` reads batches written before and after a column was added or widened."""
    return read_evolving(spark, path) if merge_schema else spark.read.parquet(path)


def overwrite_table(frame: DataFrame, path: str) -> None:
    frame.write.option("partitionOverwriteMode", "static").mode("overwrite").parquet(path)


def overwrite_partitioned(
    frame: DataFrame, path: str, partition: str, replace_all: bool = False
) -> None:
    """Replace the partitions present in ``frame``, or the whole table.

    The rebalance hint brings each partition value together to avoid one small file
    per task and value, and lets AQE split a value that is too big for one task. Partitions
    that stay may lack columns of ``frame`` or have narrower ones, which ``read_table`` settles;
    a column that fits neither way is refused before anything is written.
    """
    if not replace_all:
        check_batch(frame, path)
    (
        frame.hint("rebalance", partition)
        .write.option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .partitionBy(partition)
        .mode("overwrite")
        .parquet(path)
    )
    note_schema(frame, path)


def write_csv(frame: DataFrame, path: str) -> None:
    """RFC 4180 quoting, as ``read_csv_text`` and other readers expect it."""
    frame.write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)


def write_json_lines(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def replace_catalog_table(frame: DataFrame, name: str, partition: str | None = None) -> None:
    writer = frame.hint("rebalance", partition) if partition else frame
    writer = writer.write.option("partitionOverwriteMode", "static").mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).saveAsTable(name)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of the lake, wherever it is stored."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, without those that readers skip; none if it does not
    exist."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(target):
        return []
    names = [s.getPath().getName() for s in store.listStatus(target) if s.isDirectory()]
    return [n for n in names if "=" in n or not n.startswith(("_", "."))]


def append_evolving(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Stack two versions of a table; columns only one side has become NULL on the other."""
    return existing.unionByName(batch, allowMissingColumns=True)


def stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
