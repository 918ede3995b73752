"""As-of joins for a date per row: probes and values are merged in one order, whatever the size of a key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.sources.shared import written_once


def asof_join(
    probes: DataFrame,
    values: DataFrame,
    keys: Sequence[str],
    at: str,
    since: str,
    columns: Sequence[str] = (),
    strict: bool = False,
    forward: bool = False,
) -> DataFrame:
    """Every probe with ``since`` and ``columns`` of the last value of its key at or before ``at``, or nulls.

    ``strict`` leaves out values at the very moment; ``forward`` takes the first value at or after it instead. Of values
    of one key and moment the greatest counts. Null keys and moments match nothing, as in a join; without ``keys`` all
    values are candidates. Names of ``since`` and ``columns`` must not be names of the probes.

    Both sides are united, sorted by range of (key, moment) and numbered by partition, so a key with a third of all rows
    is spread over partitions and each carries its last value on by itself. What a partition needs from earlier ones is
    the last value of the one key that goes on into it: at most one row per partition, which is broadcast. Probes that
    share key and moment are spread as well, so no task holds a key.
    """
    names = list(keys)
    told = reduce(and_, (F.col(name).isNotNull() for name in [*names, since]))
    best = values.filter(told).groupBy(*names, since).agg(
        F.max(F.struct(*columns) if columns else F.struct(F.lit(0))).alias("_best")
    )
    moment = F.struct(F.col(since).alias("_since"), F.col("_best"))
    rows = probes.select(
        *names, F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.monotonically_increasing_id().alias("_turn"),
        F.struct(*[F.col(name) for name in probes.columns]).alias("_row"),
    )
    marks = best.select(
        *names, F.col(since).alias("_at"), F.lit(0).alias("_kind"), F.lit(0).cast("bigint").alias("_turn"),
        moment.alias("_value"),
    )
    united = rows.unionByName(marks, allowMissingColumns=True)
    time = F.col("_at").desc_nulls_first() if forward else F.col("_at").asc_nulls_first()
    kind = F.col("_kind").desc() if strict else F.col("_kind").asc()
    order = [time, kind]
    placed = written_once(
        united.repartitionByRange(*[F.col(name) for name in names], *order, "_turn").withColumn(
            "_part", F.spark_partition_id()
        ),
        "merged",
    )
    own = Window.partitionBy("_part", *names).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    seen = placed.withColumn("_own", F.last("_value", ignorenulls=True).over(own)).filter("_kind = 1")
    newest = F.min("_value") if forward else F.max("_value")
    ends = placed.groupBy("_part", *names).agg(newest.alias("_last"))
    earlier = Window.partitionBy(*names).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        "_part", *[F.col(name).alias(f"_{name}") for name in names],
        F.last("_last", ignorenulls=True).over(earlier).alias("_carried"),
    ).filter("_carried IS NOT NULL")
    # Rows are sorted by key first, so only the first key of a partition has rows in earlier ones.
    same = [F.col("_part") == F.col("_of")] + [F.col(name) == F.col(f"_{name}") for name in names]
    found = seen.join(F.broadcast(carried.withColumnRenamed("_part", "_of")), reduce(and_, same), "left")
    value = F.coalesce("_own", "_carried")
    return found.select(
        "_row.*", value["_since"].alias(since), *[value["_best"][name].alias(name) for name in columns]
    )
