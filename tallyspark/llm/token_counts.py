"""Token counts by scanning flat token files for the end-of-document identifier."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.tokens import ID_BYTES, encoder
from tallyspark.sources.shared import written_once

END_ID = 50_256
BLOCK_TOKENS = 1 << 16


def token_blocks(
    docs: DataFrame, tokenizer: str, ranks: str | None = None, end_id: int = END_ID, id_col: str = "doc_id",
    text_col: str = "text", block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """A flat token file per input partition, as its blocks: ``file, block, payload, ended``.

    A file is the identifiers of its documents, each followed by ``end_id``, two little-endian bytes per identifier
    and no index; blocks cut it anywhere. ``ended`` lists the documents whose end lies in the block, for labels alone.
    Control strings in a text are ordinary text, so ``end_id`` never occurs inside a document. A null or empty text is
    a document of no tokens.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["id"].dataType
    schema = T.StructType(
        [
            T.StructField("file", T.LongType()), T.StructField("block", T.LongType()),
            T.StructField("payload", T.BinaryType()), T.StructField("ended", T.ArrayType(id_type)),
        ]
    )

    def write(batches):
        encode = encoder(tokenizer, ranks, True).ids
        file, block = TaskContext.get().partitionId(), 0
        parts, ended, size = [], [], 0
        arrow_type = None

        def cut(data, labels):
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([file], pa.int64()), pa.array([block], pa.int64()), pa.array([data.tobytes()], pa.binary()),
                    pa.array([labels], pa.list_(arrow_type)),
                ],
                names=["file", "block", "payload", "ended"],
            )

        for batch in batches:
            arrow_type = batch.schema.field("id").type
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                ids = np.append(encode(text.as_py()), np.uint16(end_id)).astype("<u2")
                parts.append(ids)
                size += len(ids)
                ended.append((size, key))
                if size >= block_tokens:
                    data, at = np.concatenate(parts), 0
                    while size - at >= block_tokens:
                        at += block_tokens
                        inside = [label for end, label in ended if end <= at]
                        ended = ended[len(inside) :]
                        yield cut(data[at - block_tokens : at], inside)
                        block += 1
                    parts, size = [data[at:]], size - at
                    ended = [(end - at, label) for end, label in ended]
        if size:
            yield cut(np.concatenate(parts), [label for _, label in ended])

    return rows.mapInArrow(write, schema)


def read_blocks(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of flat token files in any folder Spark reads: ``file, block, payload``.

    The source reads a file whole (2 GB at most), so a task holds one file at a time.
    """
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")

    def cut(batches):
        step = block_tokens * ID_BYTES
        for batch in batches:
            for file, content in zip(batch.column("file").to_pylist(), batch.column("content"), strict=True):
                data = content.as_py() or b""
                if len(data) % ID_BYTES:
                    raise ValueError(f"{file} ends within an identifier")
                for block, at in enumerate(range(0, len(data), step)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([file]), pa.array([block], pa.int64()), pa.array([data[at : at + step]], pa.binary())],
                        names=["file", "block", "payload"],
                    )

    return files.mapInArrow(cut, "file string, block long, payload binary")


def count_tokens(blocks: DataFrame, end_id: int = END_ID) -> DataFrame:
    """One row per document: ``file, ordinal, start, n_tokens, closed, label``.

    1. Each block is searched for ``end_id`` at once; what goes on is its length and the places of the ends.
    2. Prefix scans over the blocks of a file give every block its offset, the last end before it, and the number of
       documents before it, so a document that runs over many blocks is stitched without reading them again.
    3. A document's tokens are those between two ends. Tokens after a file's last end are a document with ``closed``
       false. ``label`` is null where the blocks have no ``ended``.

    Null payloads are empty blocks; a file without tokens has no documents; an empty table gives no rows. Blocks of a
    file must be numbered in order, gaps allowed; a block number that occurs twice in a file is an error of the file.
    """
    if "ended" not in blocks.columns:
        blocks = blocks.withColumn("ended", F.lit(None).cast("array<string>"))
    label_type = blocks.schema["ended"].dataType.elementType
    file_type = blocks.schema["file"].dataType
    schema = T.StructType(
        [
            T.StructField("file", file_type), T.StructField("block", T.LongType()), T.StructField("size", T.LongType()),
            T.StructField("ends", T.ArrayType(T.LongType())), T.StructField("ended", T.ArrayType(label_type)),
        ]
    )

    def scan(batches):
        for batch in batches:
            sizes, ends = [], []
            for payload in batch.column("payload"):
                ids = np.frombuffer(payload.as_py() or b"", "<u2")
                sizes.append(len(ids))
                ends.append(np.flatnonzero(ids == end_id))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("file"), batch.column("block"), pa.array(sizes, pa.int64()),
                    pa.array(ends, pa.list_(pa.int64())), batch.column("ended"),
                ],
                names=["file", "block", "size", "ends", "ended"],
            )

    wanted = blocks.select("file", F.col("block").cast("bigint").alias("block"), "payload", "ended")
    found = written_once(wanted.mapInArrow(scan, schema), "block-ends")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offset = found.withColumn("offset", F.coalesce(F.sum("size").over(before), F.lit(0)))
    last = offset.withColumn("last_end", F.col("offset") + F.try_element_at("ends", F.lit(-1)))
    stitched = last.withColumns(
        {
            "open_from": F.coalesce(F.max("last_end").over(before), F.lit(-1)) + 1,
            "earlier": F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)),
        }
    )
    starts = F.concat(F.array("open_from"), F.transform("ends", lambda end: F.col("offset") + end + 1))
    counted = stitched.select(
        "file", "earlier",
        F.posexplode(
            F.transform(
                "ends",
                lambda end, place: F.struct(
                    F.element_at(starts, place + 1).alias("start"), (F.col("offset") + end).alias("end"),
                    F.get("ended", place).alias("label"),
                ),
            )
        ).alias("place", "document"),
    ).select(
        "file", (F.col("earlier") + F.col("place")).alias("ordinal"), F.col("document.start").alias("start"),
        (F.col("document.end") - F.col("document.start")).alias("n_tokens"), F.lit(True).alias("closed"),
        F.col("document.label").alias("label"),
    )
    tails = last.groupBy("file").agg(
        F.sum(F.size("ends")).alias("ordinal"), (F.coalesce(F.max("last_end"), F.lit(-1)) + 1).alias("start"),
        F.sum("size").alias("size"),
    )
    open_ended = tails.filter("size > start").select(
        "file", "ordinal", "start", (F.col("size") - F.col("start")).alias("n_tokens"), F.lit(False).alias("closed"),
        F.lit(None).cast(label_type).alias("label"),
    )
    return counted.unionByName(open_ended)


def op8_separator_scan(spark, folder):
    import public_tokenizers

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    blocks = token_blocks(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    )
    return count_tokens(blocks).select(F.col("label").alias("doc_id"), "n_tokens", "file", "ordinal", "start")
