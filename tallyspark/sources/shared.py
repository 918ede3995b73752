"""The shared folder in which lineage is cut and intermediate tables are kept."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = "4m"  # a batch is held several times over, by each task and its Python worker


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where the setting is missing, only a local session may fall back to a temporary folder: on a cluster such a folder
    would be gone with its executor.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="run-")
    context.setCheckpointDir(folder)
    return folder


_SCOPE: ContextVar[str | None] = ContextVar("table_scope", default=None)


@contextmanager
def table_scope(name: str) -> Iterator[None]:
    """Intermediate tables written inside belong to a scope of their own, which can be removed by itself."""
    token = _SCOPE.set(name)
    try:
        yield
    finally:
        _SCOPE.reset(token)


def run_folder(spark: SparkSession, scope: str | None = None) -> str:
    """The folder of this application's intermediate tables, or of one scope of them."""
    folder = f"{shared_folder(spark).rstrip('/')}/tables-{spark.sparkContext.applicationId}"
    return folder if scope is None else f"{folder}/scope-{scope}"


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one intermediate table."""
    return f"{run_folder(spark, _SCOPE.get())}/{name}-{uuid.uuid4().hex}"


def drop_intermediates(spark: SparkSession, scope: str | None = None) -> None:
    """Remove intermediate tables of this application, or of one scope, when no frame that reads them is needed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark, scope))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bound_batches(spark: SparkSession) -> bool:
    """Batches of a few megabytes for Python workers, unless the session sets their size; whether it did not.

    Else a batch is 10,000 rows or 64 MB, of texts or of sets.
    """
    if spark.conf.get(BATCH_SETTING, None) is not None:
        return False
    spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    return True


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside have batches as by ``bound_batches``; afterwards the session is as it was."""
    bound = bound_batches(spark)
    try:
        yield
    finally:
        if bound:
            spark.conf.unset(BATCH_SETTING)


def written_once(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Use it where a later step must see exactly the same rows twice, also after a lost executor.
    """
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
