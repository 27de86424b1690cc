from datetime import datetime
from decimal import Decimal

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from freightmill.functions.keys import shipment_hash
from freightmill.functions.labels import carrier_tier, is_delayed, risk_profile
from freightmill.functions.numeric import half_up, mean, percent, ratio, rounded_ratio_sql
from freightmill.functions.temporal import civil_date, civil_datetime, same_day_last_year


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_half_up_rounds_the_decimal_image(spark):
    got = one(spark, *[half_up(F.lit(x), 2) for x in (1.005, 0.125, -0.125, 12.345, -0.001)])
    assert [str(v) for v in got] == ["1.01", "0.13", "-0.13", "12.35", "0.00"]


def test_ratio_of_zero_or_null(spark):
    zero, none, one_ = F.lit(0), F.lit(None).cast("int"), F.lit(1)
    assert one(spark, ratio(one_, zero), ratio(one_, none), ratio(one_, zero, alternate=0)) == (
        None, None, 0.0,
    )
    assert one(spark, percent(one_, zero), mean(one_, zero, 2)) == (None, None)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(1, 10**6)), min_size=1, max_size=40))
def test_percent_is_exact_half_up_and_equal_on_duckdb(spark, pairs):
    frame = spark.createDataFrame(pairs, "part BIGINT, whole BIGINT")
    columns = frame.select(
        percent(F.col("part"), F.col("whole")),
        F.expr(rounded_ratio_sql("part", "whole", 100, 2)),
        mean(F.col("part"), F.col("whole"), 3),
        F.expr(rounded_ratio_sql("part", "whole", 1, 3)),
    ).collect()
    got = [r[0] for r in columns]
    assert all(r[0] == r[1] and r[2] == r[3] for r in columns)
    listed = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(pairs))
    duck = duckdb.sql(
        "SELECT CAST(round(CAST(CAST(a AS DOUBLE) / b * 100 AS DECIMAL(28,10)), 2) AS DOUBLE) "
        f"FROM (VALUES {listed}) AS t(i, a, b) ORDER BY i"
    ).fetchall()
    assert [float(v) for v in got] == [r[0] for r in duck]
    for value, (a, b) in zip(got, pairs):
        exact_hundredths = (2 * a * 10000 + b) // (2 * b)
        assert value == Decimal(exact_hundredths) / 100


def test_bands_include_their_lower_bound(spark):
    def tier(x):
        return carrier_tier(F.lit(Decimal(x)))

    assert one(spark, *[tier(x) for x in ("97.00", "96.99", "94.00", "93.99")]) == (
        "Tier-1 Premier", "Tier-2 Standard", "Tier-2 Standard", "Tier-3 Economy",
    )

    def risk(x):
        return risk_profile(F.lit(Decimal(x)))

    assert one(spark, *[risk(x) for x in ("4.50", "4.49", "4.00", "3.99")]) == (
        "Low Risk", "Medium Risk", "Medium Risk", "High Risk",
    )


def test_delay_sentinel(spark):
    reasons = [F.lit("None"), F.lit(None).cast("string"), F.lit("Customs Hold")]
    assert one(spark, *[is_delayed(r) for r in reasons]) == (False, False, True)


def test_unreadable_dates_become_null(spark):
    texts = ["2024-02-30", "2024-02-29 10:11:12", "soon", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t STRING")
    parsed = frame.select(civil_datetime(F.col("t")), civil_date(F.col("t"))).collect()
    assert parsed[1][0] == datetime(2024, 2, 29, 10, 11, 12)
    assert str(parsed[1][1]) == "2024-02-29"
    assert [tuple(parsed[i]) for i in (0, 2, 3)] == [(None, None)] * 3


def test_hash_does_not_depend_on_the_session_zone(spark):
    frame = spark.sql("SELECT 'S1' AS id, TIMESTAMP_NTZ'2024-03-31 02:30:00' AS at")
    seen = set()
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Europe/Berlin", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            seen.add(frame.select(shipment_hash(F.col("id"), F.col("at"))).first()[0])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    expected = duckdb.sql("SELECT md5('S1||2024-03-31 02:30:00')").fetchall()[0][0]
    assert seen == {expected}


def test_same_day_last_year(spark):
    days = ["2025-02-28", "2024-02-29", "2024-03-01"]
    got = one(spark, *[same_day_last_year(F.lit(d).cast("date")).cast("string") for d in days])
    assert got == ("2024-02-28", "2023-02-28", "2023-03-01")
