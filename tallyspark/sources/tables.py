"""Sources and sinks: any Spark format, JDBC with parallel reads, and idempotent period loads."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

JDBC_FETCH_SIZE = 100_000
JDBC_BATCH_SIZE = 100_000
JDBC_READ_PARTITIONS = 80
JDBC_WRITE_PARTITIONS = 20


@dataclass(frozen=True)
class Table:
    """Where a table lives: a Spark format plus options, and a path for file formats."""

    format: str = "parquet"
    path: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)


def read_table(spark: SparkSession, table: Table, limit: int | None = None) -> DataFrame:
    """Read a table with lower-case column names; with ``limit``, any so many rows of it, to try a load."""
    df = spark.read.format(table.format).options(**table.options).load(table.path)
    df = df.toDF(*[name.lower() for name in df.columns])
    return df if limit is None else df.limit(limit)


def append_table(df: DataFrame, table: Table) -> None:
    """Append rows to any sink."""
    df.write.format(table.format).options(**table.options).mode("append").save(table.path)


def overwrite_table(df: DataFrame, table: Table) -> None:
    """Replace the whole table. Never write to the path that ``df`` is read from."""
    df.write.format(table.format).options(**table.options).mode("overwrite").save(table.path)


def jdbc_source(
    url: str,
    relation: str,
    partition_column: str | None = None,
    lower: str | int | None = None,
    upper: str | int | None = None,
    partitions: int = JDBC_READ_PARTITIONS,
    **options: str,
) -> Table:
    """JDBC table or ``(subquery) alias``. Without a partition column and bounds Spark reads it in one task."""
    settings = {"url": url, "dbtable": relation, "fetchsize": str(JDBC_FETCH_SIZE), **options}
    bounds = (partition_column, lower, upper)
    if all(value is not None for value in bounds):
        settings |= {
            "partitionColumn": str(partition_column),
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    elif any(value is not None for value in bounds):
        raise ValueError("a parallel JDBC read needs partition_column, lower and upper together")
    return Table("jdbc", options=settings)


def jdbc_sink(url: str, relation: str, partitions: int = JDBC_WRITE_PARTITIONS, **options: str) -> Table:
    """JDBC table to write to in batches, from at most ``partitions`` connections."""
    settings = {
        "url": url, "dbtable": relation, "batchsize": str(JDBC_BATCH_SIZE), "numPartitions": str(partitions), **options,
    }
    return Table("jdbc", options=settings)


def transfer(
    spark: SparkSession,
    source: Table,
    target: Table,
    term_id: int | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    clear: Callable[[int], None] | None = None,
    limit: int | None = None,
) -> int:
    """Read a table (or ``limit`` rows of it), stamp the period, transform it and load it into another; returns the number of rows.

    With a period the target's period is replaced (``clear`` as in ``replace_period_in``), without one rows are
    appended. The rows are counted while they are written, so the source is read once.
    """
    df = read_table(spark, source, limit)
    if term_id is not None:
        df = df.withColumn("period_id", F.lit(term_id).cast("int"))
    if transform is not None:
        df = df.transform(transform)
    if term_id is not None:
        return replace_period_in(df, target, term_id, clear)
    counter = Observation()
    append_table(df.observe(counter, F.count(F.lit(1)).alias("rows")), target)
    return counter.get["rows"]


def replace_period_in(
    df: DataFrame, target: Table, term_id: int, clear: Callable[[int], None] | None = None, period: str = "period_id"
) -> int:
    """Replace one period of any sink; returns the rows written.

    File formats are partitioned by period and only the period's partition is overwritten. Other sinks, databases among
    them, are appended to after ``clear(term_id)`` has deleted the period there, which Spark cannot do for them.
    """
    counter = Observation()
    stamped = df.withColumn(period, F.lit(term_id).cast("int")).observe(counter, F.count(F.lit(1)).alias("rows"))
    if target.path is None:
        if clear is None:
            raise ValueError(f"a {target.format} sink needs a way to clear the period before it is loaded again")
        clear(term_id)
        append_table(stamped, target)
        return counter.get["rows"]
    options = {**target.options, "partitionOverwriteMode": "dynamic"}
    stamped.write.format(target.format).options(**options).mode("overwrite").partitionBy(period).save(target.path)
    rows = counter.get["rows"]
    if rows == 0:
        emptied = df.drop(period).limit(0).write.format(target.format).options(**target.options)
        emptied.mode("overwrite").save(f"{target.path.rstrip('/')}/{period}={term_id}")
    return rows


def replace_period_with_summary(df: DataFrame, path: str, term_id: int) -> DataFrame:
    """``replace_period``, and the summary of its rows that ``load_summary`` gives, from the write itself.

    Rows and values of every column are counted while they pass, so neither the source nor the table is read for it.
    """
    counter = Observation()
    counts = [F.count(f"`{name}`").alias(f"values_{place}") for place, name in enumerate(df.columns)]
    counted = df.observe(counter, F.count(F.lit(1)).alias("rows"), *counts)
    replace_period(counted, path, term_id)
    found = counter.get
    rows = [
        (found["rows"], name, kind, found[f"values_{place}"]) for place, (name, kind) in enumerate(df.dtypes)
    ]
    return df.sparkSession.createDataFrame(
        rows, "row_count long, column_name string, column_type string, non_null long"
    )


def as_view(spark: SparkSession, source: Table, name: str) -> DataFrame:
    """Make a table of any source available to ``spark.sql`` under a name."""
    df = read_table(spark, source)
    df.createOrReplaceTempView(name)
    return df


def replace_period(df: DataFrame, path: str, term_id: int | None, period: str = "period_id") -> int:
    """Load one period of a parquet table so that loading it again changes nothing; ``None`` replaces the whole table.

    The table is partitioned by period and only the loaded period is overwritten, at job commit. An empty load clears
    its period. Returns the number of rows, counted during the write.
    """
    if term_id is not None:
        return replace_period_in(df, Table("parquet", path), term_id, period=period)
    counter = Observation()
    counted = df.observe(counter, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").partitionBy(period).option("partitionOverwriteMode", "static").parquet(path)
    return counter.get["rows"]
