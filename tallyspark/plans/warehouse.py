"""The tables a month's loads write and read, as period-partitioned parquet under one folder."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators.changes import upsert
from tallyspark.operators.terms import Term
from tallyspark.sources.shared import written_once
from tallyspark.sources.tables import replace_period

NEW, ASIDE = "__new", "__aside"
BUCKETS, BUCKET = "_buckets", "_bucket"  # of a keyed table: how many, and which one a row is in
DEFAULT_BUCKETS = 64


@dataclass(frozen=True)
class Warehouse:
    """Named tables under a folder that every executor can reach."""

    spark: SparkSession
    folder: str

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name)).drop(BUCKETS, BUCKET)

    def of_term(self, name: str, term: Term) -> DataFrame:
        """Rows of one period; the filter prunes partitions."""
        return self.table(name).filter(F.col("period_id") == term.period_id)

    def load(self, name: str, df: DataFrame, term: Term) -> int:
        """Replace the period of a table; returns the rows written."""
        return replace_period(df, self.path(name), term.period_id)

    def replace(self, name: str, df: DataFrame) -> None:
        """Replace a table that has no periods; the old rows stay until the new ones are complete.

        The new table is written beside the old one. Only then is the old folder set aside and the new one put in its
        place, so a failed write changes nothing; a stop between the two moves is mended by the next look at the table.
        """
        df.write.mode("overwrite").parquet(f"{self.path(name)}{NEW}")
        self._swap(name)

    def _swap(self, name: str) -> None:
        path = self.path(name)
        files, old, new, aside = self._files(path, path, f"{path}{NEW}", f"{path}{ASIDE}")
        files.delete(aside, True)
        if files.exists(old):
            files.rename(old, aside)
        files.rename(new, old)
        files.delete(aside, True)

    def exists(self, name: str) -> bool:
        """Whether the table's folder is there. A table that cannot be read is not a missing one."""
        path = self.path(name)
        files, here, new, aside = self._files(path, path, f"{path}{NEW}", f"{path}{ASIDE}")
        if not files.exists(here) and files.exists(aside):  # a replacement stopped between its two moves
            files.rename(new if files.exists(self._path(f"{path}{NEW}/_SUCCESS")) else aside, here)
        return files.exists(here)

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self, path: str, *paths: str):
        """The file system of a path, as Spark's writers see it, and more paths on it."""
        files = self._path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        return files, *(self._path(one) for one in paths)

    def upsert(self, name: str, source: DataFrame, keys: list[str], **order: str) -> None:
        """Merge rows into a table. The whole table is written once, beside the old one that it is read from."""
        if self.exists(name):
            merged = upsert(self.table(name), source, keys, **order)
        else:
            merged = upsert(source.drop(*order.values()).limit(0), source, keys, **order)
        self.replace(name, merged)

    def periods(self, name: str, period: str = "period_id") -> list[int]:
        """Periods a table holds, from the names of its folders."""
        return sorted(int(value) for value in self._folders(name, period)) if self.exists(name) else []

    def _folders(self, name: str, column: str) -> list[str]:
        files, here = self._files(self.path(name), self.path(name))
        names = (status.getPath().getName() for status in files.listStatus(here))
        return [value for key, _, value in (one.partition("=") for one in names) if key == column]

    # ---- tables in buckets of their keys

    def upsert_buckets(
        self, name: str, source: DataFrame, keys: list[str], buckets: int = DEFAULT_BUCKETS, **order: str
    ) -> int:
        """Merge rows into a keyed table and write only the buckets that hold one of their keys; returns how many.

        Rows lie in folders by a hash of their keys. The source is stored with its buckets, the buckets it names (at
        most as many as the table has) prune the read of the table, and only they are overwritten, when the job commits.
        Files of other buckets are neither read nor written. A stop in the middle of the commit is mended by repeating
        the merge, which gives the same rows. ``buckets`` counts for a new table; an old one keeps its number.
        """
        path = self.path(name)
        if not self.exists(name):
            kept = upsert(source.drop(*order.values()).limit(0), source, keys, **order)
            self._write_buckets(kept.withColumn(BUCKETS, F.lit(buckets)), path, keys)
            return len(self._buckets_of(name))
        stored = self.spark.read.parquet(path)
        count = self.bucket_count(name)
        kinds = {key: stored.schema[key].dataType for key in keys}
        cast = source.withColumns({key: F.col(key).cast(kind) for key, kind in kinds.items()})
        changes = written_once(cast.withColumn(BUCKET, _bucket_of(keys, count)), name)
        touched = [row[0] for row in changes.select(BUCKET).distinct().collect()]
        if touched:
            old = stored.filter((F.col(BUCKETS) == count) & F.col(BUCKET).isin(touched)).drop(BUCKETS)
            merged = upsert(old, changes, [*keys, BUCKET], **order).drop(BUCKET)
            self._write_buckets(merged.withColumn(BUCKETS, F.lit(count)), path, keys, "dynamic")
        return len(touched)

    def rebucket(self, name: str, buckets: int, keys: list[str]) -> None:
        """Give a keyed table another number of buckets, when its buckets have outgrown a task."""
        new = self.table(name).withColumn(BUCKETS, F.lit(buckets))
        self._write_buckets(new, f"{self.path(name)}{NEW}", keys)
        self._swap(name)

    def bucket_count(self, name: str) -> int:
        found = self._folders(name, BUCKETS)
        if len(found) != 1:
            raise ValueError(f"{name} is no table in buckets")
        return int(found[0])

    def _buckets_of(self, name: str) -> list[str]:
        return self._folders(f"{name}/{BUCKETS}={self.bucket_count(name)}", BUCKET)

    def _write_buckets(self, rows: DataFrame, path: str, keys: list[str], mode: str = "static") -> None:
        placed = rows.withColumn(BUCKET, _bucket_of(keys, F.col(BUCKETS))).hint("rebalance", F.col(BUCKET))
        placed.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(BUCKETS, BUCKET).parquet(path)

    # ---- tables clustered by account, for joins without a shuffle

    def cluster(
        self, name: str, rows: DataFrame, key: str, count: int, partition: str | None = None, suffix: str = "clustered"
    ) -> DataFrame:
        """Store rows as a table clustered and sorted by a key, and read it.

        Tables with the same ``count`` are joined and grouped by the key without an exchange. Spark keeps the clustering
        in its catalog, so a later session makes the table known again by ``clustered``.
        """
        table = self._catalog_name(name, suffix)
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        writer = rows.write.mode("overwrite").bucketBy(count, key).sortBy(key).option("path", self.path(f"{name}__{suffix}"))
        if partition is not None:
            writer = writer.partitionBy(partition)
        writer.saveAsTable(table)
        return self.spark.table(table)

    def clustered(self, name: str, key: str, count: int, partition: str | None = None, suffix: str = "clustered") -> DataFrame:
        """A table that ``cluster`` has stored with these settings, in this session or an earlier one."""
        table = self._catalog_name(name, suffix)
        if not self.spark.catalog.tableExists(table):
            path = self.path(f"{name}__{suffix}")
            schema = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in self.spark.read.parquet(path).schema)
            parts = "" if partition is None else f"PARTITIONED BY (`{partition}`)"
            self.spark.sql(
                f"CREATE TABLE {table} ({schema}) USING parquet {parts} CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
                f"INTO {count} BUCKETS LOCATION '{path}'"
            )
            if partition is not None:
                self.spark.sql(f"MSCK REPAIR TABLE {table}")
        return self.spark.table(table)

    def _catalog_name(self, name: str, suffix: str) -> str:
        return f"{name}_{suffix}_{hashlib.md5(self.folder.encode()).hexdigest()[:12]}"


def _bucket_of(keys: list[str], buckets: int | Column) -> Column:
    count = buckets if isinstance(buckets, Column) else F.lit(buckets)
    return F.pmod(F.xxhash64(*keys), count.cast("bigint")).cast("int")
