"""Latest balances of every period, kept as a stored state that each load advances."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.valuation import advanced_state
from tallyspark.plans.warehouse import Warehouse
from tallyspark.sources.tables import replace_period

STATE = "balance_state"


def advance(warehouse: Warehouse, delta: DataFrame, period_id: int, cutoff, name: str = STATE) -> int:
    """Store the state of a period from the newest earlier state and the rows loaded for the period.

    Only those two are read, never the history. Doing it again for the newest period changes nothing, or takes in what
    its load has changed; a period that later states rest on has to go through ``restate``. Returns the rows stored.
    """
    if later := [one for one in warehouse.periods(name) if one > period_id]:
        raise ValueError(f"states of {later} rest on period {period_id}: restate from it")
    return _store(warehouse, delta, period_id, cutoff, name)


def restate(
    warehouse: Warehouse, delta_of: Callable[[int], DataFrame], cutoff_of: Callable[[int], object], first: int,
    name: str = STATE,
) -> None:
    """Store the state of ``first`` and of every later period again, after a load of ``first`` has changed."""
    for period_id in [first, *(one for one in warehouse.periods(name) if one > first)]:
        _store(warehouse, delta_of(period_id), period_id, cutoff_of(period_id), name)


def balances_at(warehouse: Warehouse, period_id: int, name: str = STATE) -> DataFrame:
    """Units of the latest day per key up to the cut-off of a period."""
    return warehouse.table(name).filter((F.col("period_id") == period_id) & ~F.col("pending")).drop(
        "period_id", "pending"
    )


def state_before(warehouse: Warehouse, delta: DataFrame, period_id: int, name: str = STATE) -> DataFrame:
    """The newest state of an earlier period; without one, no rows."""
    earlier = [one for one in warehouse.periods(name) if one < period_id]
    if not earlier:
        return delta.limit(0)
    return warehouse.table(name).filter(F.col("period_id") == earlier[-1])


def _store(warehouse: Warehouse, delta: DataFrame, period_id: int, cutoff, name: str) -> int:
    state = advanced_state(state_before(warehouse, delta, period_id, name), delta, F.lit(cutoff))
    return replace_period(state, warehouse.path(name), period_id)
