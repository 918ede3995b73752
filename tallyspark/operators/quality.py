"""Data checks on a loaded table, as rows of ``(check_name, subject, failures)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.codes import (
    DUPLICATED_VALUES, INVALID_FOREIGN_VALUES, MISSED_TABLE, MISSED_VALUES, NO_DATA, NULL_METRICS, UNEXPECTED_VALUES,
)
from tallyspark.operators.movements import union_all


@dataclass(frozen=True)
class CheckSpec:
    """What a table must satisfy."""

    required: Sequence[str] = ()
    expected: Mapping[str, Column] = field(default_factory=dict)
    keys: Sequence[Sequence[str]] = ()
    references: Mapping[str, tuple[DataFrame, str]] = field(default_factory=dict)
    metrics: Sequence[str] = ()


def quality_checks(df: DataFrame, spec: CheckSpec) -> DataFrame:
    """Failures of every check, 0 when it passes.

    Emptiness, missing and unexpected values and NULL control metrics share one scan. Duplicates are surplus rows of a
    key and orphans are counted per distinct foreign value, both after map-side aggregation.
    """

    def failing(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, 1)), F.lit(0))

    entries = [(NO_DATA, "", F.when(F.count(F.lit(1)) == 0, 1).otherwise(0))]
    entries += [(MISSED_VALUES, name, failing(F.col(name).isNull())) for name in spec.required]
    entries += [(UNEXPECTED_VALUES, name, failing(~accepted)) for name, accepted in spec.expected.items()]
    entries += [(NULL_METRICS, name, failing(F.col(name).isNull())) for name in spec.metrics]
    one_row = df.agg(*(value.cast("bigint").alias(f"_{i}") for i, (_, _, value) in enumerate(entries)))
    rows = F.array(
        *(
            F.struct(F.lit(check).alias("check_name"), F.lit(subject).alias("subject"), F.col(f"_{i}").alias("failures"))
            for i, (check, subject, _) in enumerate(entries)
        )
    )
    results = [one_row.select(F.inline(rows))]

    def result(check: str, subject: str, failures: DataFrame) -> DataFrame:
        return failures.select(F.lit(check).alias("check_name"), F.lit(subject).alias("subject"), "failures")

    for key in spec.keys:
        surplus = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
        counted = surplus.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("failures"))
        results.append(result(DUPLICATED_VALUES, ",".join(key), counted))
    for column, (parent, parent_key) in spec.references.items():
        values = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
        known = parent.select(F.col(parent_key).alias(column))
        orphans = values.join(known, column, "left_anti")
        counted = orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("failures"))
        results.append(result(INVALID_FOREIGN_VALUES, column, counted))
    return union_all(results)


def missing_tables(expected: Sequence[str], present: Sequence[str]) -> list[str]:
    """Names of expected tables that a source does not have."""
    return sorted(set(expected) - set(present))
