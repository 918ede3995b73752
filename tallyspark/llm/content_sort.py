"""Exact duplicates by content sort: range partitioning on normalised bytes, external sort, neighbour comparison."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.sources.shared import written_once

HEAD_BYTES = 32


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their UTF-8 bytes are equal after lower-casing A-Z only. A null text counts as empty, so nulls
    and empty texts form one group. Exactly one row of a group has ``kept``: the one with the largest (or smallest)
    identifier; a null identifier loses to any other, and of rows with the same identifier one is taken. Repeated rows
    are members like any other. An empty table gives no rows; other columns are not read.
    """
    rows = _labelled(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), keep, None)
    return _resolved(rows).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )


def drop_exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest"
) -> DataFrame:
    """The kept row of every group of equal texts, with all its columns as they were, whatever their names.

    Null texts are empty texts here as well, so one row of them stays, its text as it was. Of rows with the same text and
    identifier one stays; null identifiers lose to others. An empty table gives no rows.
    """
    names = docs.columns
    rest = [F.col(f"`{name}`").alias(f"c{place}") for place, name in enumerate(names) if name != text_col]
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
        F.struct(*rest, F.lit(True).alias("there")).alias("row"),
    )
    kept = _resolved(_labelled(rows, keep, rows.schema["row"].dataType)).filter("kept")
    return kept.select(
        *[
            F.col("text").alias(name) if name == text_col else F.col("row")[f"c{place}"].alias(name)
            for place, name in enumerate(names)
        ]
    )


def _labelled(rows: DataFrame, keep: str, row_type: T.DataType | None) -> DataFrame:
    """Rows with their run in the sorted order, written once because run limits depend on the partitioning.

    The range is over (head of the normalised bytes, SHA-256, identifier): splitters stay small, equal texts are
    adjacent, and a group that holds a third of all rows is cut by identifier into many partitions. With a ``row_type``
    only the last row of each run is given, with its text and its other columns.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep must be largest or smallest, not {keep}")
    schema = T.StructType(
        [*rows.schema.fields, T.StructField("head", T.BinaryType()), T.StructField("sha", T.BinaryType())]
    )
    keyed = rows.mapInArrow(_with_keys, schema)
    by_id = F.col("id").asc_nulls_first() if keep == "largest" else F.col("id").desc_nulls_first()
    ordered = keyed.repartitionByRange("head", "sha", by_id).sortWithinPartitions("head", "sha", by_id, "text")
    fields = [T.StructField("id", rows.schema["id"].dataType)]
    if row_type is not None:
        fields += [T.StructField("text", rows.schema["text"].dataType), T.StructField("row", row_type)]
    fields += [
        T.StructField("sha", T.BinaryType()), T.StructField("last_id", rows.schema["id"].dataType),
        T.StructField("in_run", T.LongType()), T.StructField("is_last", T.BooleanType()),
        T.StructField("is_edge", T.BooleanType()), T.StructField("part", T.IntegerType()),
    ]
    columns = rows.columns if row_type is not None else ["id"]
    return written_once(
        ordered.mapInArrow(_runs(columns, row_type is not None), T.StructType(fields)), "content-sorted"
    )


def _resolved(rows: DataFrame) -> DataFrame:
    """Join runs that continue in another partition.

    Only the first and the last run of a partition can, so the joined side has at most two rows per partition and its
    broadcast is bounded by twice the number of shuffle partitions.
    """
    edges = rows.filter("is_edge AND is_last").select("sha", "part", "last_id", "in_run")
    whole = edges.groupBy("sha").agg(
        F.sum("in_run").alias("group_rows"), F.max("part").alias("last_part"),
        F.max_by("last_id", "part").alias("group_last"),
    ).withColumnRenamed("sha", "edge_sha")
    joined = rows.join(F.broadcast(whole), F.col("is_edge") & (F.col("sha") == F.col("edge_sha")), "left")
    stitched = F.col("edge_sha").isNotNull()
    return joined.withColumns(
        {
            "keep_id": F.when(stitched, F.col("group_last")).otherwise(F.col("last_id")),
            "group_size": F.when(stitched, F.col("group_rows")).otherwise(F.col("in_run")),
            "kept": F.col("is_last") & (~stitched | (F.col("part") == F.col("last_part"))),
        }
    )


def normalised(text: bytes | None) -> bytes:
    """``bytes.lower`` touches A-Z only."""
    return b"" if text is None else text.lower()


def _with_keys(batches):
    for batch in batches:
        texts = [normalised(text) for text in batch.column("text").cast(pa.binary()).to_pylist()]
        heads = pa.array([text[:HEAD_BYTES] for text in texts], pa.binary())
        shas = pa.array([hashlib.sha256(text).digest() for text in texts], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns, heads, shas], names=[*batch.schema.names, "head", "sha"])


def _runs(columns: list[str], last_only: bool):
    def label(batches):
        part = TaskContext.get().partitionId()
        done: list[tuple] = []  # (one-row slices or ids, sha, last id, rows, edge)
        run: dict | None = None
        first = True

        def close(is_edge: bool):
            done.append((run["rows"], run["sha"], run["last"], run["size"], is_edge))

        def flush():
            out = {name: [] for name in ("sha", "last_id", "in_run", "is_last", "is_edge", "part")}
            kept: list = []
            for rows, sha, last, size, is_edge in done:
                kept.extend(rows)
                count = len(rows)
                out["sha"] += [sha] * count
                out["last_id"] += [last] * count
                out["in_run"] += [size] * count
                out["is_last"] += [False] * (count - 1) + [True]
                out["is_edge"] += [is_edge] * count
                out["part"] += [part] * count
            done.clear()
            if last_only:
                arrays = pa.Table.from_batches(kept).combine_chunks().to_batches()[0].columns
            else:
                arrays = [pa.array(kept, id_type)]
            tail = [
                pa.array(out["sha"], pa.binary()), pa.array(out["last_id"], id_type), pa.array(out["in_run"], pa.int64()),
                pa.array(out["is_last"], pa.bool_()), pa.array(out["is_edge"], pa.bool_()),
                pa.array(out["part"], pa.int32()),
            ]
            return pa.RecordBatch.from_arrays([*arrays, *tail], names=[*columns, *out])

        id_type = None
        for batch in batches:
            id_type = batch.schema.field("id").type
            ids = batch.column("id").to_pylist()
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            shas = batch.column("sha").to_pylist()
            whole = batch.select(columns) if last_only else None
            for position, (key, text, sha) in enumerate(zip(ids, texts, shas, strict=True)):
                text = normalised(text)
                member = whole.slice(position, 1) if last_only else key
                if run is not None and run["text"] == text:
                    run["size"] += 1
                    run["last"] = key
                    if last_only:
                        run["rows"] = [member]
                    else:
                        run["rows"].append(member)
                    continue
                if run is not None:
                    close(first)
                    first = False
                run = {"text": text, "sha": sha, "size": 1, "last": key, "rows": [member]}
            if done:
                yield flush()
        if run is not None:
            close(True)
            yield flush()

    return label


SQL = """
WITH n AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g ON n.t = g.t"""


def op5_exact_dedup(spark, folder):
    return exact_duplicates(spark.read.parquet(f"{folder}/documents.parquet"))
