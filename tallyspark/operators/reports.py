"""Control reports with subtotals, and load summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.operators.movements import union_all
from tallyspark.operators.numbering import number_rows

DETAIL, SUBTOTAL, TOTAL = "detail", "subtotal", "total"


def control_report(
    df: DataFrame,
    display: Sequence[str],
    sums: Mapping[str, str],
    distinct: Mapping[str, str] | None = None,
    additive: bool = False,
    sum_type: str = "decimal(38,2)",
) -> DataFrame:
    """Detail rows by all display columns, a subtotal per value of each display column, and a grand total.

    ``sums`` and ``distinct`` map result names to input columns. ``row_kind`` tells the three kinds apart and
    ``grouped_by`` names the column of a subtotal; display columns that are not grouped are NULL, and a NULL label is a
    group of its own. Subtotals are rounded last and count distinct keys anew; with ``additive`` they add up the
    detail rows as shown. The input is aggregated to the display columns (plus the counted keys) before subtotals
    multiply rows.
    """
    distinct = dict(distinct or {})
    keys = list(dict.fromkeys(distinct.values()))
    base = df.select(*display, *keys, *(F.col(column).alias(name) for name, column in sums.items()))
    if sums:
        base = base.groupBy(*display, *keys).agg(*(F.sum(name).alias(name) for name in sums))
    else:
        base = base.distinct()

    def measures(counting: bool) -> list[Column]:
        counts = [
            F.countDistinct(key).alias(name) if counting else F.sum(name).cast("bigint").alias(name)
            for name, key in distinct.items()
        ]
        return counts + [F.sum(name).cast(sum_type).alias(name) for name in sums]

    detail = base.groupBy(*display).agg(*measures(counting=True))
    source = detail if additive else base
    counting = not additive
    columns = [F.col(name) for name in display]
    grouped_by = F.coalesce(*(F.when(F.grouping(name) == 0, F.lit(name)) for name in display))
    subtotals = source.groupingSets([[column] for column in columns], *columns).agg(
        grouped_by.alias("grouped_by"), *measures(counting)
    )
    total = source.agg(*measures(counting))
    kinds = (
        (DETAIL, detail.withColumn("grouped_by", F.lit(None).cast("string"))),
        (SUBTOTAL, subtotals),
        (TOTAL, total.withColumn("grouped_by", F.lit(None).cast("string"))),
    )
    order = [*display, *distinct, *sums]
    return union_all(df.withColumn("row_kind", F.lit(kind)) for kind, df in kinds).select(
        "row_kind", "grouped_by", *order
    )


def run_subtotals(
    detail: DataFrame, display: Sequence[str], values: Sequence[str], order: Sequence[str], blocks: int = 1024
) -> DataFrame:
    """Subtotals of a report read top to bottom: one whenever the value of a display column changes.

    Every display column has its own runs, so the same value can give several subtotals when the order does not keep it
    together. Rows are numbered in the given order, and a change is found by joining each row with its successor. Runs
    are numbered by prefix sums within ``blocks`` blocks of consecutive rows; only the sums of the blocks, a fixed
    number per column, are added up in one window. ``last_row`` is the number of the row after which the subtotal
    stands.
    """
    numbered = number_rows(detail, [F.col(name).asc_nulls_first() for name in order], "_n")
    per_block = F.lit(numbered.count() // blocks + 1)
    flagged = numbered.join(
        numbered.select((F.col("_n") + 1).alias("_n"), *(F.col(name).alias(f"_before_{name}") for name in display)),
        "_n",
        "left",
    )
    entries = F.array(
        *(
            F.struct(
                F.lit(name).alias("grouped_by"), F.col(name).cast("string").alias("value"),
                ((F.col("_n") > 1) & ~F.col(name).eqNullSafe(F.col(f"_before_{name}"))).cast("int").alias("_changed"),
            )
            for name in display
        )
    )
    long = flagged.select("_n", F.floor(F.col("_n") / per_block).alias("_block"), *values, F.inline(entries))
    changes = long.groupBy("grouped_by", "_block").agg(F.sum("_changed").alias("_changes"))
    earlier = Window.partitionBy("grouped_by").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = changes.select(
        "grouped_by", "_block", F.coalesce(F.sum("_changes").over(earlier), F.lit(0)).alias("_offset")
    )
    within = Window.partitionBy("grouped_by", "_block").orderBy("_n").rowsBetween(Window.unboundedPreceding, 0)
    return (
        long.withColumn("_run", F.sum("_changed").over(within))
        .join(offsets, ["grouped_by", "_block"])
        .groupBy("grouped_by", (F.col("_offset") + F.col("_run")).alias("_run"), "value")
        .agg(F.max("_n").alias("last_row"), *(F.sum(name).alias(name) for name in values))
        .select("grouped_by", "value", "last_row", *values)
    )


def load_summary(df: DataFrame) -> DataFrame:
    """Rows, and per column its type and number of values, from a single aggregation."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *(F.count(f"`{name}`").alias(name) for name in df.columns))
    entries = F.array(
        *(
            F.struct(
                F.lit(name).alias("column_name"), F.lit(dtype).alias("column_type"),
                F.col(f"`{name}`").alias("non_null"),
            )
            for name, dtype in df.dtypes
        )
    )
    return counts.select(F.col("_rows").alias("row_count"), F.inline(entries))
