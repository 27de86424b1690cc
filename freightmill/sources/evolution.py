"""Tables whose columns are added or widened from batch to batch.

Two types have a common one where every value of both is held exactly; anything else is refused.
The schema of each batch is noted beside the table, so a reader knows the common schema without
opening a single file, and Spark widens the values of older files as it scans them.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SCHEMA_NOTES = "_schemas"

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: Digits that hold every value of a whole type, as Spark's reader asks for them.
_DIGITS = {T.ByteType: 10, T.ShortType: 10, T.IntegerType: 10, T.LongType: 20}


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds every value of both exactly; None if there is none."""
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _common_struct(a, b, strict=False)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        element = common_type(a.elementType, b.elementType)
        return element and T.ArrayType(element, a.containsNull or b.containsNull)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        key, value = common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType)
        nulls = a.valueContainsNull or b.valueContainsNull
        return T.MapType(key, value, nulls) if key and value else None
    return _common_atom(a, b) or _common_atom(b, a)


def _common_atom(a: T.DataType, b: T.DataType) -> T.DataType | None:
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    if isinstance(b, T.DoubleType) and isinstance(a, (T.FloatType, *_WHOLE[:3])):
        return b
    # A float has 24 bits, so whole numbers of 32 need a double.
    if isinstance(b, T.FloatType) and isinstance(a, _WHOLE[:3]):
        return T.DoubleType()
    if isinstance(b, T.DecimalType) and isinstance(a, (T.DecimalType, *_WHOLE)):
        scale = max(b.scale, getattr(a, "scale", 0))
        before = getattr(a, "precision", 0) - getattr(a, "scale", 0) or _DIGITS.get(type(a), 0)
        precision = scale + max(b.precision - b.scale, before)
        return T.DecimalType(precision, scale) if precision <= 38 else None
    if isinstance(a, T.DateType) and isinstance(b, T.TimestampNTZType):
        return b
    return None


def _common_struct(a: T.StructType, b: T.StructType, strict: bool) -> T.StructType | None:
    fields = {f.name: f for f in a.fields}
    for f in b.fields:
        if f.name not in fields:
            fields[f.name] = f
            continue
        kind = common_type(fields[f.name].dataType, f.dataType)
        if kind is None:
            if not strict:
                return None
            raise TypeError(
                f"column {f.name}: {fields[f.name].dataType.simpleString()} and "
                f"{f.dataType.simpleString()} have no common type that holds both exactly"
            )
        fields[f.name] = T.StructField(f.name, kind)
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields.values()])


def common_schema(schemas: list[T.StructType]) -> T.StructType:
    """All columns of all schemas in their common types; raises where two have none."""
    return reduce(lambda a, b: _common_struct(a, b, strict=True), schemas, T.StructType([]))


def noted_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The common schema of a table's batches; None where none was noted."""
    notes = f"{path}/{SCHEMA_NOTES}"
    target = spark._jvm.org.apache.hadoop.fs.Path(notes)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return None
    # One line for each schema the table has had.
    found = spark.read.option("recursiveFileLookup", True).schema("schema STRING").parquet(notes)
    schemas = [T.StructType.fromJson(json.loads(r[0])) for r in found.distinct().collect()]
    return common_schema(sorted(schemas, key=lambda s: s.json())) if schemas else None


def check_batch(batch: DataFrame, path: str) -> T.StructType:
    """The table's schema with the batch in it; raises, before anything is written, where a
    column has no common type."""
    before = noted_schema(batch.sparkSession, path)
    return common_schema([s for s in (before, batch.schema) if s is not None])


def note_schema(batch: DataFrame, path: str) -> None:
    """Note the schema that a batch brings, if it changes what the table reads as."""
    spark = batch.sparkSession
    before = noted_schema(spark, path)
    if before is not None and common_schema([before, batch.schema]) == before:
        return
    row = spark.createDataFrame([(batch.schema.json(),)], "schema STRING").coalesce(1)
    row.write.parquet(f"{path}/{SCHEMA_NOTES}/{uuid.uuid4().hex}")


def append_batch(batch: DataFrame, path: str) -> None:
    """Add a batch with columns of its own, or of narrower or wider types, to a table."""
    check_batch(batch, path)
    batch.write.mode("append").parquet(path)
    note_schema(batch, path)


def read_evolving(
    spark: SparkSession, path: str, wanted: T.StructType | None = None
) -> DataFrame:
    """All batches of a table as one: columns that a batch lacks are NULL, types the common ones.

    ``wanted`` asks for columns in types of its own, which must hold every value: a narrower
    one is refused. Where no schema was noted, the files are asked.
    """
    schema = noted_schema(spark, path)
    if schema is None:
        schema = spark.read.option("mergeSchema", True).parquet(path).schema
    for field in wanted or ():
        stored = schema[field.name].dataType if field.name in schema.fieldNames() else field.dataType
        if common_type(stored, field.dataType) != field.dataType:
            raise TypeError(
                f"column {field.name}: {field.dataType.simpleString()} does not hold every "
                f"{stored.simpleString()}"
            )
    return spark.read.schema(wanted or schema).parquet(path)
