from datetime import date, timedelta

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from surveil.functions import periods as p


@pytest.mark.parametrize(
    "day, expected",
    [
        (date(2021, 1, 2), (2020, 53, 7)),
        (date(2021, 1, 3), (2021, 1, 1)),
        (date(2023, 1, 1), (2023, 1, 1)),
        (date(2024, 12, 29), (2025, 1, 1)),
    ],
)
def test_epi_week_edges(spark, rows, day, expected):
    assert p.epi_week(day) == expected
    df = spark.createDataFrame([(day,)], "d date")
    assert rows(df.select(p.mmwr_year("d"), p.mmwr_week("d"), p.mmwr_day("d"))) == [expected]


@given(st.dates(date(1990, 1, 1), date(2035, 12, 31)))
def test_epi_week_round_trip(day):
    assert p.epi_date(*p.epi_week(day)) == day


def test_columns_agree_with_driver_on_every_day(spark):
    days = spark.range(16801).select(F.date_add(F.lit(date(1990, 1, 1)), F.col("id").cast("int")).alias("d"))
    weeks = days.select(
        "d", p.mmwr_year("d").alias("y"), p.mmwr_week("d").alias("w"), p.mmwr_day("d").alias("k"),
        p.week_ending("d").alias("e"), p.season_year("d").alias("s"),
    ).withColumn("back", p.mmwr_to_date("y", "w", "k"))
    for r in weeks.collect():
        assert (r.y, r.w, r.k) == p.epi_week(r.d)
        assert r.back == r.d
        assert r.e.weekday() == 5 and 0 <= (r.e - r.d).days <= 6
        assert p.epi_date(r.s, 40, 1) <= r.d < p.epi_date(r.s + 1, 40, 1)


def test_years_with_week_53():
    years = [y for y in range(1990, 2036) if p.epi_week(p.epi_date(y, 53, 1))[0] == y]
    assert years == [1992, 1997, 2003, 2008, 2014, 2020, 2025, 2031]


def test_previous_month(spark, rows):
    assert p.ReportPeriod(date(2024, 3, 31)).previous_month == (date(2024, 2, 1), date(2024, 2, 29))
    df = spark.createDataFrame([(date(2024, 3, 31),), (date(2024, 1, 1),)], "d date")
    assert rows(df.select(*p.previous_month_bounds("d"))) == [
        (date(2023, 12, 1), date(2023, 12, 31)),
        (date(2024, 2, 1), date(2024, 2, 29)),
    ]


def test_previous_week_over_the_new_year():
    assert p.ReportPeriod(date(2021, 1, 5)).previous_epi_week == (2020, 53)
    assert p.ReportPeriod(date(2023, 1, 3)).previous_epi_week == (2022, 52)
    assert p.ReportPeriod(date(2023, 1, 3)).previous_week_end == date(2022, 12, 31)


def test_season_windows():
    period = p.ReportPeriod(date(2024, 1, 10))
    seasons = period.season_windows(5)
    assert period.season_start == date(2023, 10, 1)
    assert [s.label for s in seasons] == ["2018-19", "2019-20", "2020-21", "2021-22", "2022-23", "2023-24"]
    for a, b in zip(seasons, seasons[1:]):
        assert a.end + timedelta(days=1) == b.start
    assert seasons[-1].end == date(2024, 1, 6)


def test_season_of_week_53_and_of_week_40():
    assert p.ReportPeriod(date(2021, 1, 2)).season_start == date(2020, 9, 27)
    assert p.ReportPeriod(date(2020, 9, 27)).season_start == date(2020, 9, 27)
    assert p.ReportPeriod(date(2020, 9, 26)).season_start == date(2019, 9, 29)


def test_extract_month():
    assert p.ReportPeriod(date(2024, 12, 30)).extract_month() == (2024, 12)  # week 1 of 2025
    assert p.ReportPeriod(date(2025, 1, 2)).extract_month() == (2024, 12)
    assert p.ReportPeriod(date(2022, 1, 1)).extract_month() == (2022, 1)  # week 52 of 2021
    assert p.ReportPeriod(date(2024, 6, 3)).extract_month() == (2024, 6)


def test_labels_and_lags(spark, rows):
    df = spark.createDataFrame([(date(2024, 3, 9), date(2024, 3, 1)), (None, date(2024, 3, 1))], "a date, b date")
    out = df.select(
        p.month_year_label("a"), p.lag_days("a", "b"), p.older_than("b", date(2024, 4, 2), 32).alias("old")
    )
    assert rows(out) == [(None, None, False), ("March 2024", 8, False)]
    assert rows(df.select(p.older_than("b", date(2024, 4, 3), 32).alias("o")).distinct()) == [(True,)]
