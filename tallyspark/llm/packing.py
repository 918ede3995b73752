"""Packing into fixed-length sequences along a space-filling curve through document vectors."""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.tokens import ID_BYTES, encoder
from tallyspark.sources.shared import written_once

SEQUENCE = 1024
END_ID = 0
BUCKETS, DIMENSIONS, BITS = 1024, 3, 16
PART_SHIFT = 40  # a sequence number is its partition, shifted, plus its place there


@lru_cache(maxsize=4)
def projection(seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and sign of every token identifier, and the random directions of the buckets."""
    rng = np.random.default_rng(seed)
    buckets = rng.integers(0, BUCKETS, 1 << (8 * ID_BYTES))
    signs = rng.choice([-1.0, 1.0], 1 << (8 * ID_BYTES))
    return buckets, signs, rng.standard_normal((BUCKETS, DIMENSIONS))


def grid_point(ids: np.ndarray, seed: int) -> list[int]:
    """Cell of a document: its hashed token counts at unit length, projected and squeezed into a fixed grid."""
    buckets, signs, directions = projection(seed)
    vector = np.bincount(buckets[ids], weights=signs[ids], minlength=BUCKETS)
    length = np.sqrt(vector @ vector)
    place = (vector @ directions) / length if length > 0 else np.zeros(DIMENSIONS)
    return [int(cell) for cell in (np.tanh(place / 2) + 1) / 2 * ((1 << BITS) - 1)]


def hilbert_key(cell: list[int], bits: int = BITS) -> int:
    """Place of a cell on the Hilbert curve: undo excess work from the top bit down, Gray-encode, interleave."""
    axes = list(cell)
    top = 1 << (bits - 1)
    step = top
    while step > 1:
        mask = step - 1
        for axis in range(len(axes)):
            if axes[axis] & step:
                axes[0] ^= mask
            else:
                swap = (axes[0] ^ axes[axis]) & mask
                axes[0] ^= swap
                axes[axis] ^= swap
        step >>= 1
    for axis in range(1, len(axes)):
        axes[axis] ^= axes[axis - 1]
    flip, step = 0, top
    while step > 1:
        if axes[-1] & step:
            flip ^= step - 1
        step >>= 1
    key = 0
    for bit in range(bits - 1, -1, -1):
        for value in axes:
            key = key << 1 | ((value ^ flip) >> bit & 1)
    return key


def pack(
    docs: DataFrame, tokenizer: str, ranks: str | None = None, size: int = SEQUENCE, end_id: int = END_ID,
    id_col: str = "doc_id", text_col: str = "text", seed: int = 11, with_ids: bool = False,
) -> DataFrame:
    """Pieces of documents in sequences of ``size`` tokens: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset`` and, on demand, the piece's ``ids`` (little-endian, two bytes each).

    1. A task encodes its texts, adds ``end_id``, and computes each document's place on the Hilbert curve. Whole
       sequences are cut off the front of a document; only their checksums (or ids) and the rest travel on. That is
       written once, because the splitters of the range are sampled from it before it is sorted.
    2. Documents are range-partitioned and sorted by (place, identifier), so neighbours on the curve are neighbours
       in a partition, and equal documents, however many, spread over partitions by identifier.
    3. Each partition lays the rests along the curve end to end and cuts at every full sequence. Only the last
       sequence of a partition is padded.

    Null and empty texts are one ``end_id``. Repeated rows and repeated or null identifiers are documents of their own.
    An empty table gives no rows; columns other than the two are not read.
    """
    id_type = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    made = rows.mapInArrow(
        _encode(tokenizer, ranks, size, end_id, seed, with_ids),
        T.StructType(
            [
                T.StructField("doc_id", id_type), T.StructField("curve", T.LongType()),
                T.StructField("tokens", T.LongType()), T.StructField("full", T.BinaryType()),
                T.StructField("rest", T.BinaryType()), T.StructField("rest_crc32", T.LongType()),
            ]
        ),
    )
    encoded = written_once(made, "encoded")
    order = ["curve", F.col("doc_id").asc_nulls_first(), "tokens", "rest_crc32"]
    along = encoded.repartitionByRange(*order).sortWithinPartitions(*order)
    fields = [
        T.StructField("doc_id", id_type), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    ]
    fields += [T.StructField("ids", T.BinaryType())] * with_ids
    return along.mapInArrow(_lay(size, with_ids), T.StructType(fields))


def _encode(tokenizer: str, ranks: str | None, size: int, end_id: int, seed: int, with_ids: bool):
    def run(batches):
        encode = encoder(tokenizer, ranks).ids
        end = np.array([end_id], "<u2")
        for batch in batches:
            curves, tokens, fulls, rests, crcs = [], [], [], [], []
            for text in batch.column("text"):
                ids = encode(text.as_py())
                curves.append(hilbert_key(grid_point(ids, seed)))
                ids = np.concatenate([ids, end])
                whole = len(ids) // size * size
                if with_ids:
                    fulls.append(ids[:whole].tobytes())
                else:
                    sums = [zlib.crc32(ids[at : at + size].tobytes()) for at in range(0, whole, size)]
                    fulls.append(np.array(sums, "<u4").tobytes())
                rest = ids[whole:].tobytes()
                tokens.append(len(ids))
                rests.append(rest)
                crcs.append(zlib.crc32(rest))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(curves, pa.int64()), pa.array(tokens, pa.int64()),
                    pa.array(fulls, pa.binary()), pa.array(rests, pa.binary()), pa.array(crcs, pa.int64()),
                ],
                names=["doc_id", "curve", "tokens", "full", "rest", "rest_crc32"],
            )

    return run


def _lay(size: int, with_ids: bool):
    def run(batches):
        base = TaskContext.get().partitionId() << PART_SHIFT
        made = 0  # sequences begun so far
        current, used = None, 0  # the open sequence of rests
        for batch in batches:
            rows, owners = [], []
            for owner, (tokens, full, rest) in enumerate(
                zip(
                    batch.column("tokens").to_pylist(), batch.column("full").to_pylist(),
                    batch.column("rest").to_pylist(), strict=True,
                )
            ):
                whole = tokens // size * size
                for at in range(0, whole, size):
                    if with_ids:
                        ids = full[at * ID_BYTES : (at + size) * ID_BYTES]
                        crc = zlib.crc32(ids)
                    else:
                        ids, crc = None, int.from_bytes(full[at // size * 4 : at // size * 4 + 4], "little")
                    rows.append((at, size, crc, tokens, base + made, 0, ids))
                    owners.append(owner)
                    made += 1
                done = 0
                while done < tokens - whole:
                    if current is None:
                        current, used = base + made, 0
                        made += 1
                    take = min(size - used, tokens - whole - done)
                    ids = rest[done * ID_BYTES : (done + take) * ID_BYTES]
                    rows.append((whole + done, take, zlib.crc32(ids), tokens, current, used, ids))
                    owners.append(owner)
                    done += take
                    used += take
                    if used == size:
                        current = None
            if not rows:
                continue
            columns = [batch.column("doc_id").take(pa.array(owners, pa.int32()))]
            columns += [pa.array(values, pa.int64()) for values in list(zip(*rows, strict=True))[:6]]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                columns.append(pa.array([row[6] for row in rows], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def op2_hilbert_packing(spark, folder):
    import public_tokenizers

    return pack(
        spark.read.parquet(f"{folder}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
    )
