"""Connected components of an edge table by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.sources.shared import written_once

MAX_ROUNDS = 100
TASK_EDGES = 200_000  # edges (16 bytes each) for which a round takes one more task, beyond one per core


def connected_components(edges: DataFrame) -> DataFrame:
    """``vertex, component`` for every vertex of the edges ``a, b`` (longs); the component is its smallest vertex.

    Each round hangs larger neighbours on the smallest neighbour, then smaller ones, until only stars are left; the
    number of rounds grows with the logarithm of the size. Every step is an aggregation with map-side combine and a
    join of two stored tables, which adaptive execution can split at a hub. Two numbers reach the driver per round.
    The tables of a round are written by as many tasks as their edges call for, whatever the number of shuffle
    partitions, because a round of many empty tasks takes the longer the less there is to do.
    Nulls and loops are left out; no edges give no rows.
    """
    current = written_once(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("w")).distinct(), "edges"
    )
    seen = _fingerprint(current)
    for _ in range(MAX_ROUNDS):
        tasks = _tasks(current, seen[0])
        current = _star(_star(current, True, tasks), False, tasks)
        now = _fingerprint(current)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    leaves = current.select(F.col("v").alias("vertex"), F.col("w").alias("component"))
    roots = current.select(F.col("w").alias("vertex"), F.col("w").alias("component")).distinct()
    return leaves.unionByName(roots)


def _fingerprint(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "w").cast("decimal(20,0)"))).first())


def _tasks(edges: DataFrame, count: int) -> int:
    return max(edges.sparkSession.sparkContext.defaultParallelism, -(-count // TASK_EDGES))


def _star(edges: DataFrame, large: bool, tasks: int) -> DataFrame:
    """Edges have ``v > w``. Large: neighbours above v hang on v's smallest neighbour; small: those below, and v."""
    around = edges
    if large:
        around = edges.unionByName(edges.select(F.col("w").alias("v"), F.col("v").alias("w")))
    lowest = written_once(around.groupBy("v").agg(F.min("w").alias("low")).coalesce(tasks), "lowest").withColumn(
        "low", F.least("v", "low")
    )
    joined = around.join(lowest, "v")
    if large:
        hung = joined.filter("w > v").select(F.col("w").alias("v"), F.col("low").alias("w"))
    else:
        hung = joined.select("v", F.col("low").alias("w")).unionByName(
            joined.select(F.col("w").alias("v"), F.col("low").alias("w"))
        )
    return written_once(hung.filter("v <> w").distinct().coalesce(tasks), "edges")
