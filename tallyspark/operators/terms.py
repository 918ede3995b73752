"""Periods: their dates, and stamping loaded rows with one."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.calendar import period_start


@dataclass(frozen=True)
class Term:
    """The dates of one period."""

    period_id: int
    label: str
    start: date
    end: date
    next_start: date
    price_date: date
    previous_cutoff: date
    previous_price_date: date

    def covers(self, moment: Column) -> Column:
        """Every moment of the period's days, the last day to its end, for dates and timestamps alike."""
        return (moment >= F.lit(self.start)) & (moment < F.lit(self.next_start))

    @property
    def yyyymmdd_bounds(self) -> tuple[int, int]:
        """Bounds for sources that keep dates as integers."""
        return int(self.start.strftime("%Y%m%d")), int(self.end.strftime("%Y%m%d"))


def term_dates(periods: DataFrame, same_day_price: bool = False) -> DataFrame:
    """All dates of every period of a ``(period_id, period)`` table.

    The previous price date is the end of the previous month. With ``same_day_price`` it is the same day number one
    month earlier, clipped to the length of that month.
    """
    start = period_start(F.col("period"))
    end = F.last_day(start)
    one_month_back = F.add_months(end, -1)
    return periods.select(
        "period_id",
        "period",
        start.alias("start_date"),
        end.alias("end_date"),
        F.add_months(start, 1).alias("next_start"),
        end.alias("price_date"),
        start.alias("previous_cutoff"),
        (one_month_back if same_day_price else F.last_day(one_month_back)).alias("previous_price_date"),
    )


def resolve_term(periods: DataFrame, term_id: int, same_day_price: bool = False) -> Term:
    """Dates of one period. Only the single matching row reaches the driver."""
    found = term_dates(periods.filter(F.col("period_id") == term_id), same_day_price).take(2)
    if not found:
        raise LookupError(f"period {term_id} does not exist")
    if len(found) > 1:
        raise LookupError(f"period {term_id} is defined more than once")
    return Term(*found[0])


def stamp_period(df: DataFrame, term_id: int) -> DataFrame:
    """Mark loaded rows with their period."""
    return df.withColumn("period_id", F.lit(term_id).cast("int"))
