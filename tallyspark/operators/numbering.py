"""Gap-free row numbers without a single-task window, and pages of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.sources.shared import written_once

_POSITION_BITS = 33


def number_rows(df: DataFrame, order: Sequence[Column | str], name: str = "id", start: int = 1) -> DataFrame:
    """Consecutive numbers in a total order over the whole frame.

    Rows are range-partitioned and sorted, and every row notes its partition and its position there. That frame is
    written to the shared folder once, because numbers are offsets (rows in earlier partitions) plus positions and both
    must come from the same partitioning even if an executor is lost in between. The window over partition counts has
    one row per partition. ``order`` must be unique, or equal rows get their numbers in arbitrary order.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    slot = F.monotonically_increasing_id()
    placed = ranged.withColumns(
        {
            "_part": F.shiftright(slot, _POSITION_BITS).cast("int"),
            "_position": slot.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
        }
    )
    fixed = written_once(placed, "numbered")
    counts = fixed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    # At most one row per shuffle partition, so this broadcast is bounded by spark.sql.shuffle.partitions.
    return fixed.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + F.col("_position") + F.lit(start)).cast("bigint").alias(name)
    )


def page_rows(df: DataFrame, size: int, key: str = "id", name: str = "page") -> DataFrame:
    """Page of each row by its number: rows 0 to size-1 are page 0. No row is left out at the end."""
    return df.withColumn(name, F.floor(F.col(key) / F.lit(size)).cast("bigint"))
