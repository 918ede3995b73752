"""Period arithmetic as column expressions; everything here stays inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PERIOD_FORMAT = "MM/yyyy"


def period_start(label: Column) -> Column:
    """First day of a ``MM/yyyy`` period label."""
    return F.to_date(label, PERIOD_FORMAT)


def is_due(day: Column, months: Column) -> Column:
    """True in the months in which something produced every ``months`` months is due."""
    return F.pmod(F.month(day), months) == 0


def lookback_start(start: Column, months: Column, inclusive: bool = True) -> Column:
    """First day of a window of ``months`` months that ends with the month of ``start``.

    ``inclusive=False`` reaches one month further back, which is how opening balances are looked up.
    """
    return F.add_months(start, -(months - 1) if inclusive else -months)


def in_window(day: Column, start: Column, end: Column, months: Column, inclusive: bool = True) -> Column:
    """Range predicate for a look-back window whose length is a column."""
    return day.between(lookback_start(start, months, inclusive), end)


def as_yyyymmdd(day: Column) -> Column:
    """Date as an integer such as 19980331."""
    return F.date_format(day, "yyyyMMdd").cast("int")


def from_yyyymmdd(value: Column) -> Column:
    """Integer such as 19980331 as a date."""
    return F.to_date(value.cast("string"), "yyyyMMdd")


def compact_period(label: Column, year_first: bool) -> Column:
    """``MM/yyyy`` without the slash: ``yyyyMM`` for statement ids, ``MMyyyy`` elsewhere."""
    if year_first:
        return F.concat(F.substring(label, 4, 4), F.substring(label, 1, 2))
    return F.replace(label, F.lit("/"), F.lit(""))


def clock_seconds(text: Column) -> Column:
    """Seconds of a ``HH:MM`` limit."""
    parts = F.split(text, ":")
    return parts[0].cast("int") * 3600 + parts[1].cast("int") * 60
