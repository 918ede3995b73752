"""Running sums of the returns, stored per period, for windows of any length."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.statements import FLOWS
from tallyspark.plans.warehouse import Warehouse
from tallyspark.sources.tables import replace_period

SUMS = "return_sums"


def advance_sums(warehouse: Warehouse, returns: DataFrame, period_id: int, name: str = SUMS) -> int:
    """Store the sums of all periods up to one, per account and sub-account, with the number of ``rows`` behind them.

    They are those of the newest earlier period that has them plus the returns since, so one step reads a period of sums
    and the periods of returns after it. Sums of later periods rest on these: after a load of an old period has changed,
    advance from it through all later ones. Returns the rows stored.
    """
    earlier = [one for one in warehouse.periods(name) if one < period_id]
    since = returns.filter(F.col("period_id") <= period_id)
    measures = [F.coalesce(column, F.lit(0)).cast("decimal(28,4)").alias(column) for column in FLOWS]
    keys = ("account_id", "subaccount_id")
    if earlier:
        since = since.filter(F.col("period_id") > earlier[-1])
    rows = since.select(*keys, *measures, F.lit(1).cast("bigint").alias("rows"))
    if earlier:
        before = warehouse.table(name).filter(F.col("period_id") == earlier[-1])
        rows = rows.unionByName(before.select(*keys, *FLOWS, "rows"))
    summed = rows.groupBy(*keys).agg(
        *[F.sum(column).cast("decimal(28,4)").alias(column) for column in FLOWS], F.sum("rows").alias("rows")
    )
    return replace_period(summed, warehouse.path(name), period_id)
