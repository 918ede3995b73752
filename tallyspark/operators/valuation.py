"""As-of prices, latest balances and their valuation."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.codes import BALANCE_KIND
from tallyspark.operators.asof import asof_join
from tallyspark.operators.numbering import number_rows
from tallyspark.sources.shared import written_once

BALANCE_KEYS = ("account_id", "fund_id", "subaccount_id")
SALTS = 8


def cutoff_date(history: DataFrame, after: date, ts: str = "settled_at") -> DataFrame:
    """One row: the first history date strictly after ``after``, or ``after`` itself while there is none yet."""
    return history.filter(F.col(ts) > F.lit(after)).agg(
        F.coalesce(F.min(ts), F.lit(after).cast(history.schema[ts].dataType)).alias("cutoff")
    )


def _latest_day(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    by_day = Window.partitionBy(*keys).orderBy(F.to_date(ts).desc())
    return df.withColumn("_rank", F.rank().over(by_day)).filter(F.col("_rank") == 1).drop("_rank")


def latest_per_group(
    history: DataFrame, as_of: Column, keys: Sequence[str] = BALANCE_KEYS, ts: str = "settled_at"
) -> DataFrame:
    """All rows of the latest day on or before ``as_of``, per key.

    The latest day of a key is a maximum, combined where the history is read. The rows are then joined on key and day,
    and adaptive execution splits a key with most rows on that day.
    """
    day = F.to_date(ts)
    in_scope = history.filter(F.col(ts) <= as_of)
    last = in_scope.groupBy(*keys).agg(F.max(day).alias("_day"))
    joined = in_scope.withColumn("_own_day", day).join(
        last.select(*(F.col(key).alias(f"_{key}") for key in keys), F.col("_day").alias("_own_day")), "_own_day"
    )
    same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    return joined.filter(reduce(and_, same)).select(*history.columns)


def latest_units(history: DataFrame, as_of: Column, salts: int = SALTS) -> DataFrame:
    """Units of the latest day on or before ``as_of``, summed per account, fund, sub-account and moment.

    A key may have most rows of the table on one day, which no ranking can cut down. So the latest day is taken within
    ``(key, salt)`` first, where rows take salts in turn, equal ones too; what is left is summed map-side and by
    moment, and the latest day of the key is taken from the sums.
    """
    in_scope = history.filter(F.col("settled_at") <= as_of).select(
        *BALANCE_KEYS, "settled_at", "units",
        F.pmod(F.monotonically_increasing_id(), F.lit(salts)).alias("_salt"),
    )
    summed = (
        _latest_day(in_scope, [*BALANCE_KEYS, "_salt"], "settled_at")
        .groupBy(*BALANCE_KEYS, "settled_at")
        .agg(F.round(F.sum("units"), 6).cast("decimal(18,6)").alias("units"))
    )
    return _latest_day(summed, BALANCE_KEYS, "settled_at")


def price_as_of(prices: DataFrame, as_of: Column, keys: Sequence[str] = ("fund_id", "regime_id")) -> DataFrame:
    """The last share price on or before ``as_of`` per fund and regime; equal dates take the higher price."""
    last = F.max(F.struct("price_date", "price"))
    return (
        prices.filter(F.col("price_date") <= as_of)
        .groupBy(*keys)
        .agg(last.alias("_last"))
        .select(*keys, F.col("_last.price_date").alias("price_date"), F.col("_last.price").alias("price"))
    )


def subaccount_prices(subaccounts: DataFrame, prices: DataFrame, price_date: Column) -> DataFrame:
    """Price per fund and sub-account, reached through the regime of the sub-account."""
    regimes = subaccounts.select("subaccount_id", "regime_id")
    return (
        price_as_of(prices, price_date)
        .join(regimes, "regime_id")
        .select("fund_id", "subaccount_id", "price_date", "price")
    )


def value_balances(
    history: DataFrame,
    subaccounts: DataFrame,
    prices: DataFrame,
    cutoff: Column,
    price_date: Column,
    kind: str = BALANCE_KIND,
) -> DataFrame:
    """Latest balance per account, fund, sub-account and moment, valued at the share price as of ``price_date``.

    Units are summed to the result grain before prices are attached: the price is constant within a group, so the
    amount is the same and the price join sees only one row per balance. Balances without a price are dropped.
    """
    return value_units(latest_units(history, cutoff), subaccounts, prices, price_date, kind)


# ---- balances as a state that loads advance

def advanced_state(state: DataFrame, delta: DataFrame, cutoff: Column, salts: int = SALTS) -> DataFrame:
    """The balance state at ``cutoff`` from the state at an earlier one and the rows loaded since.

    A state holds, per key, the units of its latest day up to the cutoff, summed by moment, and in rows marked
    ``pending`` the units of later moments. A loaded row may be older than the state: on an earlier day it changes
    nothing, on the latest day it is added, so late rows count as if they had been there. Rows are cut down and summed
    as in ``latest_units``; a pending day is ranked by itself, so all its moments stay.
    """
    rows = state.select(*BALANCE_KEYS, "settled_at", "units").unionByName(
        delta.select(*BALANCE_KEYS, "settled_at", "units")
    )
    later = F.col("settled_at") > cutoff
    keys = [*BALANCE_KEYS, "_day"]
    slotted = rows.withColumns(
        {
            "_day": F.when(later, F.to_date("settled_at")),
            "_salt": F.pmod(F.monotonically_increasing_id(), F.lit(salts)),
        }
    )
    summed = (
        _latest_day(slotted, [*keys, "_salt"], "settled_at")
        .groupBy(*keys, "settled_at")
        .agg(F.sum("units").cast("decimal(18,6)").alias("units"))
    )
    return _latest_day(summed, keys, "settled_at").select(
        *BALANCE_KEYS, "settled_at", "units", F.col("_day").isNotNull().alias("pending")
    )


def value_units(
    units: DataFrame, subaccounts: DataFrame, prices: DataFrame, price_date: Column, kind: str = BALANCE_KIND
) -> DataFrame:
    """Units per account, fund, sub-account and moment, valued at the share price as of ``price_date``."""
    price = subaccount_prices(subaccounts, prices, price_date)
    return units.join(price, ["fund_id", "subaccount_id"]).select(
        *BALANCE_KEYS, "settled_at", F.lit(kind).alias("kind"), "price_date", "units",
        F.round(F.col("units") * F.col("price"), 2).cast("decimal(18,2)").alias("amount"),
    )


# ---- many dates at once

def cutoff_dates(history: DataFrame, terms: DataFrame, after: str = "next_start", ts: str = "settled_at") -> DataFrame:
    """The terms with ``cutoff``: the first history moment strictly after ``after``, or ``after`` while there is none."""
    moments = history.select(F.col(ts).alias("_moment")).distinct()
    probes = terms.withColumn("_after", F.col(after).cast(history.schema[ts].dataType))
    found = asof_join(probes, moments, [], "_after", "_moment", strict=True, forward=True)
    return found.select(*terms.columns, F.coalesce("_moment", "_after").alias("cutoff"))


def cutoff_slices(terms: DataFrame) -> DataFrame:
    """One row per different cutoff: its number ``slice`` from 0, ``above`` (the cutoff before) and ``cutoff``."""
    numbered = number_rows(terms.select("cutoff").distinct(), ["cutoff"], "slice", start=0)
    before = numbered.select((F.col("slice") + 1).alias("slice"), F.col("cutoff").alias("above"))
    return numbered.join(before, "slice", "left").select("slice", "above", "cutoff")


def sliced(history: DataFrame, slices: DataFrame, ts: str = "settled_at") -> DataFrame:
    """History rows with the first slice whose cutoff is not before them; rows after the last cutoff go.

    Slices are spread over their days, so that rows find theirs by an equality of days. Earlier days belong to the first.
    """
    first_day = slices.agg(F.min(F.to_date("cutoff")).alias("_day")).scalar()
    days = slices.select(
        "slice", "above", "cutoff",
        F.explode(F.sequence(F.to_date(F.coalesce("above", "cutoff")), F.to_date("cutoff"))).alias("_day"),
    )
    own = F.col(ts)
    dated = history.withColumn("_day", F.greatest(F.to_date(ts), first_day))
    inside = (own <= F.col("cutoff")) & (F.col("above").isNull() | (own > F.col("above")))
    return dated.join(days, "_day").filter(inside).select(*history.columns, "slice")


def units_by_moment(history: DataFrame) -> DataFrame:
    """Units summed per account, fund, sub-account and moment, stored: what balances of many dates read again.

    Rows are summed where they are read, so a key with most rows of the table at one moment costs one row per task, and
    one with many moments is spread by them.
    """
    return written_once(history.groupBy(*BALANCE_KEYS, "settled_at").agg(F.sum("units").alias("units")), "units")


def latest_units_by_slice(units: DataFrame, slices: DataFrame) -> DataFrame:
    """Units of the latest day of each key up to every cutoff: ``latest_units`` of all slices in one pass.

    ``units`` has one row per key and moment. ``slice, until`` are the first and last slice for which the row is the
    latest. Rows are cut down to the last day within (key, slice) where they are read. The next slice of a key is the
    smallest among its later ones, a running minimum from the last slice down.
    """
    dated = sliced(units.select(*BALANCE_KEYS, "settled_at", "units"), slices)
    latest = _latest_day(dated, [*BALANCE_KEYS, "slice"], "settled_at")
    newest = slices.agg(F.max("slice")).scalar()
    later = Window.partitionBy(*BALANCE_KEYS).orderBy(F.col("slice").desc()).rangeBetween(Window.unboundedPreceding, -1)
    return latest.select(
        *BALANCE_KEYS, "slice", "settled_at", F.round("units", 6).cast("decimal(18,6)").alias("units"),
        F.coalesce(F.min("slice").over(later) - 1, newest).alias("until"),
    )


def prices_by_slice(subaccounts: DataFrame, prices: DataFrame, terms: DataFrame, slices: DataFrame) -> DataFrame:
    """One row per fund and sub-account: ``told``, an array over all slices of the priced terms of each.

    Prices as of all dates come from one as-of join of dates and prices. The size is that of funds, sub-accounts and
    terms, whatever the history holds; it is stored, so that its size is known when it is joined.
    """
    dated = terms.join(slices, "cutoff").select("period_id", "slice", F.col("price_date").alias("_asked"))
    dates = terms.agg(F.collect_set("price_date")).scalar()  # one date a term
    asked = prices.select("fund_id", "regime_id").distinct().withColumn("_asked", F.explode(dates))
    priced = asof_join(asked, prices, ["fund_id", "regime_id"], "_asked", "price_date", ["price"])
    by_subaccount = priced.filter("price IS NOT NULL").join(subaccounts.select("subaccount_id", "regime_id"), "regime_id")
    term = F.struct("period_id", "price_date", "price")
    by_slice = (
        by_subaccount.join(dated, "_asked")
        .groupBy("fund_id", "subaccount_id", "slice").agg(F.collect_list(term).alias("terms"))
        .groupBy("fund_id", "subaccount_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("slice", "terms"))).alias("of"))
    )
    every = by_slice.crossJoin(slices.agg(F.sequence(F.min("slice"), F.max("slice")).alias("every")))
    nothing = F.slice(F.map_values("of")[0], 1, 0)
    told = F.transform("every", lambda one: F.coalesce(F.col("of")[one], nothing))
    return written_once(every.select("fund_id", "subaccount_id", told.alias("told")), "prices")


def balances_of_terms(
    history: DataFrame, subaccounts: DataFrame, prices: DataFrame, terms: DataFrame, kind: str = BALANCE_KIND,
    summed: bool = False,
) -> DataFrame:
    """``value_balances`` of every term at once: ``terms`` has ``period_id, cutoff, price_date``.

    The history is read once, whatever the number of terms; with ``summed`` it is what ``units_by_moment`` made of it.
    Each balance meets the prices of its fund and sub-account once and is then told for all terms up to the next one of
    its key, which is the size of the result: no row of the result is joined or shuffled.
    """
    terms = written_once(terms.select("period_id", "cutoff", "price_date"), "terms")
    slices = written_once(cutoff_slices(terms), "slices")
    latest = latest_units_by_slice(history if summed else units_by_moment(history), slices)
    own = F.slice("told", (F.col("slice") + 1).cast("int"), (F.col("until") - F.col("slice") + 1).cast("int"))
    told = latest.join(prices_by_slice(subaccounts, prices, terms, slices), ["fund_id", "subaccount_id"]).select(
        *BALANCE_KEYS, "settled_at", "units", F.explode(F.flatten(own)).alias("_term")
    )
    return told.select(
        "_term.period_id", *BALANCE_KEYS, "settled_at", F.lit(kind).alias("kind"), "_term.price_date", "units",
        F.round(F.col("units") * F.col("_term.price"), 2).cast("decimal(18,2)").alias("amount"),
    )
