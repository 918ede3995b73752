"""Exact distinct counts that can be merged: accounts of each group as bitmaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANGE, BITS = "id_range", "ids"  # which 32,768 identifiers, and which of them are there


def id_bitmaps(rows: DataFrame, groups: Sequence[str], key: str) -> DataFrame:
    """``groups, id_range, ids``: the different values of a whole-number key in each group.

    Bits are set where the rows are read, so a group that holds a third of all rows costs 4 KB per task and range of
    identifiers. Null keys set no bit, but their group is there.
    """
    return rows.groupBy(*groups, F.bitmap_bucket_number(key).alias(RANGE)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias(BITS)
    )


def merged_bitmaps(bitmaps: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Bitmaps of coarser groups, or of several periods together, from finer ones."""
    return bitmaps.groupBy(*groups, RANGE).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_counts(bitmaps: DataFrame, groups: Sequence[str], name: str = "clients") -> DataFrame:
    """Exact number of different keys per group, also where groups share keys."""
    counted = merged_bitmaps(bitmaps, groups).groupBy(*groups)
    return counted.agg(F.sum(F.bitmap_count(BITS)).alias(name))


def distinct_subtotals(
    bitmaps: DataFrame, levels: Sequence[Sequence[str]], name: str = "clients", level_name: str = "level"
) -> DataFrame:
    """Distinct counts of every level, given from fine to coarse, each a part of the one before.

    Every level is merged from the one before, so bitmaps of accounts are read once; columns that a level does not have
    are null, and ``level`` is its number.
    """
    columns = list(levels[0])
    made, current = [], bitmaps
    for number, level in enumerate(levels):
        if not set(level) <= set(levels[max(0, number - 1)]):
            raise ValueError("a level must be a part of the one before")
        current = merged_bitmaps(current, level)
        counted = current.groupBy(*level).agg(F.sum(F.bitmap_count(BITS)).alias(name))
        kinds = {column: bitmaps.schema[column].dataType for column in columns}
        made.append(
            counted.select(
                *[F.col(c) if c in level else F.lit(None).cast(kinds[c]).alias(c) for c in columns],
                F.lit(number).alias(level_name), F.coalesce(name, F.lit(0)).alias(name),
            )
        )
    out = made[0]
    for one in made[1:]:
        out = out.unionByName(one)
    return out
