from datetime import date

from helpers import values

from freightmill.operators.prior_period import with_prior_year, with_prior_year_daily


def test_month_grain(spark):
    series = spark.createDataFrame(
        [(2023, 1, 10), (2024, 1, 15), (2024, 2, 7), (2026, 1, 1)], "y INT, m INT, v INT"
    )
    assert values(with_prior_year(series, "y", ["m"], "v")) == [
        (2023, 1, 10, None), (2024, 1, 15, 10), (2024, 2, 7, None), (2026, 1, 1, None),
    ]


def test_year_grain(spark):
    series = spark.createDataFrame([(2023, 10), (2024, 15)], "y INT, v INT")
    assert values(with_prior_year(series, "y", [], "v")) == [(2023, 10, None), (2024, 15, 10)]


def test_day_grain_around_leap_days(spark):
    days = ["2023-02-28", "2023-03-01", "2024-02-28", "2024-02-29", "2024-03-01", "2025-02-28",
            "2025-03-01"]
    series = spark.createDataFrame(
        [(date.fromisoformat(d), i) for i, d in enumerate(days)], "d DATE, v INT"
    )
    got = {str(r.d): r.prior_v for r in with_prior_year_daily(series, "d", [], "v").collect()}
    assert got == {
        "2023-02-28": None, "2023-03-01": None, "2024-02-28": 0, "2024-02-29": 0,
        "2024-03-01": 1, "2025-02-28": 2, "2025-03-01": 4,
    }


def test_null_values_keep_their_row(spark):
    series = spark.createDataFrame([(2023, None), (2024, 5)], "y INT, v INT")
    assert values(with_prior_year(series, "y", [], "v")) == [(2023, None, None), (2024, 5, None)]
