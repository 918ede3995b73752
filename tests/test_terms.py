from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyspark.functions import calendar, codes
from tallyspark.operators import terms


@pytest.fixture
def periods(spark):
    return spark.createDataFrame(
        [(1, "12/2023"), (2, "04/2023"), (3, "03/2023"), (4, "02/2024"), (5, "01/2023"), (5, "02/2023")],
        "period_id int, period string",
    )


def test_december_rolls_over(periods):
    term = terms.resolve_term(periods, 1)
    assert (term.start, term.end, term.next_start) == (date(2023, 12, 1), date(2023, 12, 31), date(2024, 1, 1))


def test_previous_price_date_by_flag(periods):
    assert terms.resolve_term(periods, 2).previous_price_date == date(2023, 3, 31)
    assert terms.resolve_term(periods, 2, same_day_price=True).previous_price_date == date(2023, 3, 30)
    assert terms.resolve_term(periods, 3).previous_price_date == date(2023, 2, 28)
    assert terms.resolve_term(periods, 3, same_day_price=True).previous_price_date == date(2023, 2, 28)


def test_leap_month_and_bounds(periods):
    term = terms.resolve_term(periods, 4)
    assert term.end == date(2024, 2, 29)
    assert term.yyyymmdd_bounds == (20240201, 20240229)
    assert term.previous_cutoff == term.start


def test_unknown_and_repeated_period(periods):
    with pytest.raises(LookupError):
        terms.resolve_term(periods, 99)
    with pytest.raises(LookupError):
        terms.resolve_term(periods, 5)


def test_last_day_bounds(spark, periods):
    term = terms.resolve_term(periods, 3)
    moments = spark.createDataFrame(
        [(datetime(2023, 3, 31, 0, 0),), (datetime(2023, 3, 31, 10, 0),), (datetime(2023, 4, 1),)], "t timestamp_ntz"
    )
    assert moments.filter(term.covers(F.col("t"))).count() == 2


def test_due_months(spark):
    months = spark.range(1, 13).select(F.make_date(F.lit(2023), F.col("id").cast("int"), F.lit(1)).alias("d"), "id")
    for n in (1, 2, 3, 4, 6, 12):
        due = months.filter(calendar.is_due(F.col("d"), F.lit(n))).select("id").collect()
        assert [row.id for row in due] == [m for m in range(1, 13) if m % n == 0]


def test_lookback_is_clipped_by_month_length(spark):
    row = spark.range(1).select(
        calendar.lookback_start(F.lit(date(2023, 3, 1)), F.lit(4)).alias("inclusive"),
        calendar.lookback_start(F.lit(date(2023, 3, 1)), F.lit(4), inclusive=False).alias("before"),
        calendar.as_yyyymmdd(F.lit(date(2023, 3, 9))).alias("number"),
        calendar.from_yyyymmdd(F.lit(20230309)).alias("day"),
        calendar.compact_period(F.lit("03/2023"), True).alias("year_first"),
        calendar.compact_period(F.lit("03/2023"), False).alias("month_first"),
    ).first()
    assert row.inclusive == date(2022, 12, 1)
    assert row.before == date(2022, 11, 1)
    assert (row.number, row.day) == (20230309, date(2023, 3, 9))
    assert (row.year_first, row.month_first) == ("202303", "032023")


def test_account_from_contract_number(spark):
    rows = spark.createDataFrame([("00-12a",), ("",), ("abc",), (None,)], "n string")
    assert [row[0] for row in rows.select(codes.digits_key(F.col("n"))).collect()] == [12, None, None, None]


def test_flags_are_packed_from_the_highest_bit(spark):
    flags = spark.range(1).select(codes.pack_flags(F.lit(True), F.lit(False), F.lit(True), F.lit(True)).alias("f"))
    assert flags.first().f == 11
