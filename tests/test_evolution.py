"""Batches written before and after a column was added or widened."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from helpers import values
from pyspark.sql import types as T

from freightmill.sources.evolution import (
    append_batch,
    common_schema,
    common_type,
    noted_schema,
    read_evolving,
)
from freightmill.sources.lake import overwrite_partitioned, read_table

BYTE, SHORT, INT, LONG = T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()
FLOAT, DOUBLE, DATE, TIME = T.FloatType(), T.DoubleType(), T.DateType(), T.TimestampNTZType()
TEXT = T.StringType()


def dec(precision, scale):
    return T.DecimalType(precision, scale)


@pytest.mark.parametrize(
    "a, b, common",
    [
        (BYTE, SHORT, SHORT), (INT, LONG, LONG), (INT, INT, INT), (FLOAT, DOUBLE, DOUBLE),
        (INT, DOUBLE, DOUBLE), (SHORT, FLOAT, DOUBLE), (LONG, DOUBLE, None), (LONG, FLOAT, None),
        (dec(10, 2), dec(12, 2), dec(12, 2)), (dec(10, 2), dec(9, 4), dec(12, 4)),
        (INT, dec(12, 4), dec(14, 4)), (LONG, dec(12, 2), dec(22, 2)),
        (dec(38, 0), dec(10, 2), None), (DATE, TIME, TIME), (TEXT, INT, None), (DATE, TEXT, None),
        (T.ArrayType(INT), T.ArrayType(LONG), T.ArrayType(LONG)),
        (T.ArrayType(INT), T.ArrayType(TEXT), None), (dec(10, 2), DOUBLE, None),
        (T.MapType(TEXT, INT), T.MapType(TEXT, DOUBLE), T.MapType(TEXT, DOUBLE)),
    ],
)
def test_common_types(a, b, common):
    assert common_type(a, b) == common == common_type(b, a)


def test_the_common_type_does_not_depend_on_the_order():
    kinds = [BYTE, SHORT, INT, LONG, FLOAT, DOUBLE, dec(10, 2), dec(20, 4), DATE, TIME, TEXT]
    for a in kinds:
        for b in kinds:
            for c in kinds:
                left = common_type(a, b) and common_type(common_type(a, b), c)
                right = common_type(b, c) and common_type(a, common_type(b, c))
                if left and right:
                    assert left == right


def test_batches_before_and_after_a_widening_read_as_one(spark, tmp_path):
    path = f"{tmp_path}/t"
    append_batch(spark.sql(
        "SELECT 1 AS id, CAST(7 AS INT) AS n, CAST(1.5 AS FLOAT) AS f, 2.50BD AS d, "
        "DATE'2024-03-01' AS t, named_struct('x', 1) AS s, array(1, 2) AS a"
    ), path)
    append_batch(spark.sql(
        "SELECT 2 AS id, 5000000000L AS n, 0.1D AS f, CAST(123456.1234 AS DECIMAL(12,4)) AS d, "
        "TIMESTAMP_NTZ'2024-03-02 10:00:00' AS t, named_struct('x', 6000000000L, 'y', 'new') AS s, "
        "array(7000000000L) AS a, 'more' AS added"
    ), path)
    # A narrower batch is widened like an older one.
    append_batch(spark.sql("SELECT 3 AS id, CAST(9 AS SMALLINT) AS n"), path)
    table = read_evolving(spark, path)
    assert dict(table.dtypes) == {
        "id": "int", "n": "bigint", "f": "double", "d": "decimal(12,4)", "t": "timestamp_ntz",
        "s": "struct<x:bigint,y:string>", "a": "array<bigint>", "added": "string",
    }
    rows = {r.id: r for r in table.collect()}
    assert (rows[1].n, rows[1].f, rows[1].d, rows[1].added) == (7, 1.5, Decimal("2.5000"), None)
    assert rows[1].t == datetime(2024, 3, 1) and tuple(rows[1].s) == (1, None) and rows[1].a == [1, 2]
    assert (rows[2].n, rows[2].f, rows[2].d) == (5_000_000_000, 0.1, Decimal("123456.1234"))
    assert tuple(rows[2].s) == (6_000_000_000, "new") and rows[2].added == "more"
    assert (rows[3].n, rows[3].d) == (9, None)


def test_what_holds_less_is_refused(spark, tmp_path):
    path = f"{tmp_path}/t"
    append_batch(spark.sql("SELECT 1 AS id, 5000000000L AS n"), path)
    with pytest.raises(TypeError, match="column n: bigint and string"):
        append_batch(spark.sql("SELECT 2 AS id, 'x' AS n"), path)
    with pytest.raises(TypeError, match="column n: bigint and double"):
        append_batch(spark.sql("SELECT 2 AS id, 1.0D AS n"), path)
    assert read_evolving(spark, path).count() == 1
    wide = T.StructType([T.StructField("n", dec(24, 2))])
    assert values(read_evolving(spark, path, wide)) == [(Decimal("5000000000.00"),)]
    with pytest.raises(TypeError, match="column n: int does not hold every bigint"):
        read_evolving(spark, path, T.StructType([T.StructField("n", INT)]))
    with pytest.raises(TypeError, match="no common type"):
        common_schema([T.StructType([T.StructField("a", k)]) for k in (DATE, INT)])


def test_days_before_and_after_a_widening(spark, tmp_path):
    path = f"{tmp_path}/t"
    old = "SELECT 1 AS id, CAST(7 AS INT) AS n, DATE'2024-03-01' AS day"
    overwrite_partitioned(spark.sql(old), path, "day")
    overwrite_partitioned(
        spark.sql("SELECT 2 AS id, 5000000000L AS n, 'x' AS note, DATE'2024-03-02' AS day"), path, "day"
    )
    table = read_table(spark, path, merge_schema=True)
    assert values(table, "id", "n", "note", "day") == [
        (1, 7, None, date(2024, 3, 1)), (2, 5_000_000_000, "x", date(2024, 3, 2)),
    ]
    before = noted_schema(spark, path)
    overwrite_partitioned(spark.sql(old), path, "day")
    assert noted_schema(spark, path) == before
    with pytest.raises(TypeError, match="column id"):
        overwrite_partitioned(spark.sql("SELECT 'a' AS id, DATE'2024-03-01' AS day"), path, "day")
    assert read_table(spark, path, merge_schema=True).count() == 2
