"""Keyed changes of a table: upserts, column updates, seeds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.joins import first_per_key
from tallyspark.operators.movements import union_all


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    batch: str | None = None,
    position: str | None = None,
) -> DataFrame:
    """The target after inserting or updating the rows of the source.

    The last batch wins, and inside a batch the first row by ``position``; without these columns ties are settled by
    the remaining columns, so a repeated run gives the same table. Target rows are kept by an anti join: with a source
    of bounded size the target is not shuffled. The source should carry every column of the target; one it lacks is
    NULL in its rows.
    """
    values = [name for name in source.columns if name not in (*keys, batch, position)]
    order = []
    if batch:
        order.append(F.col(batch).desc())
    if position:
        order.append(F.col(position))
    order += [F.col(name).asc_nulls_last() for name in values]
    winners = first_per_key(source, keys, order or [F.col(keys[0])]).select(*keys, *values)
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(winners, allowMissingColumns=True)


def update_from(target: DataFrame, source: DataFrame, key: str, column: str, value: str = "value") -> DataFrame:
    """Set one column of the rows that the source names; other rows keep theirs.

    A key that the source names more than once takes its lowest value.
    """
    changes = source.groupBy(key).agg(F.min(value).alias("_new"))
    joined = target.join(changes, key, "left")
    columns = [
        F.coalesce("_new", F.col(name)).alias(name) if name == column else F.col(name) for name in target.columns
    ]
    return joined.select(*columns)


def seed_clients(clients: DataFrame, term_id: int) -> DataFrame:
    """One empty fact row per client and period."""
    return clients.select(
        "account_id", F.lit(term_id).cast("int").alias("period_id"), F.lit("{}").alias("indicators")
    )


def indicator_objects(
    clients: DataFrame, updates: Mapping[str, DataFrame], key: str = "account_id", value: str = "value"
) -> DataFrame:
    """``account_id, indicators``: per client one VARIANT object of the values that all sources have for it.

    ``updates`` map the name of an indicator to its ``(account_id, value)`` frame. All of them meet in one aggregation,
    where a chain of updates would join the clients once per indicator. A name that a source has more than once for a
    client takes its lowest value; null values are left out, accounts that are no clients too.
    """
    rows = [clients.select(key, F.lit(None).cast("string").alias("_name"), F.lit(None).cast("string").alias("_value"))]
    for name, source in updates.items():
        rows.append(source.select(key, F.lit(name).alias("_name"), F.col(value).cast("string").alias("_value")))
    lowest = union_all(rows).groupBy(key, "_name").agg(F.min("_value").alias("_value"))
    entry = F.when(F.col("_value").isNotNull(), F.struct("_name", "_value"))
    grouped = lowest.groupBy(key).agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("_map"),
        F.max(F.col("_name").isNull()).alias("_client"),
    )
    return grouped.filter("_client").select(key, F.to_variant_object("_map").alias("indicators"))
