"""SimHash near-duplicates: fingerprints that differ in few bits, found by segment variants with one wildcard bit."""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.components import connected_components
from tallyspark.sources.shared import written_once

WORDS = 4
DIFFERENCE = 4  # differing bits up to which fingerprints link
SEED = 42
BITS = 64
PART = 1 << 15  # shingles whose bits are counted at a time
BLOCK = 512  # fingerprints of one variant that are compared within a task, and on each side of a tile
TILES = 16  # blocks of a variant on the left side of the tiles of one task


# ---- fingerprints

def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    """Bit i is 1 if it is set in over half of the XXH64 hashes of the shingles, repeats included; 0 without words.

    Words are separated by space and 0x09 to 0x0D, as ``bytes.split`` does; ``bytes.lower`` touches A-Z only. A text of
    fewer words is one shingle.
    """
    found = text.lower().split() if text else []
    if not found:
        return 0
    line = b" ".join(found)
    ends = np.cumsum([len(word) + 1 for word in found])
    starts = (ends - np.fromiter(map(len, found), np.int64, len(found)) - 1).tolist()
    stops = (ends - 1)[min(words, len(found)) - 1 :].tolist()
    hashed = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for first in range(0, len(stops), PART):
        spans = zip(starts[first : first + PART], stops[first : first + PART])
        hashes = np.array([hashed(line[start:stop], SEED) for start, stop in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, BITS // 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(stops), bitorder="little").view("<u8")[0])


def _sign(words: int):
    def run(batches):
        for batch in batches:
            texts = (text.as_buffer().to_pybytes() if text.is_valid else None for text in batch.column("text"))
            prints = [fingerprint(text, words) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(prints, np.uint64).view(np.int64))], names=["doc_id", "fp"]
            )

    return run


# ---- variants

def segments(difference: int = DIFFERENCE) -> list[tuple[int, int]]:
    """First bit and length of the segments: so few that, of fingerprints that link, one differs in at most one bit.

    With ``difference // 2 + 1`` segments, two or more differing bits in each would be more than ``difference``.
    """
    count = difference // 2 + 1
    cuts = [BITS * place // count for place in range(count + 1)]
    return [(first, last - first) for first, last in zip(cuts, cuts[1:])]


def variant_keys(fp: Column, difference: int = DIFFERENCE) -> Column:
    """64 keys, one per bit: that bit's segment without the bit. Fingerprints that link have one of them in common."""
    keys = []
    for first, length in segments(difference):
        for bit in range(first, first + length):
            mask = ((1 << length) - 1) ^ (1 << (bit - first))
            value = F.shiftrightunsigned(fp, first).bitwiseAND(F.lit(mask).cast("bigint"))
            keys.append(F.struct(F.lit(bit).cast("tinyint").alias("bit"), value.alias("rest")))
    return F.array(*keys)


# ---- comparisons inside a task

def close_pairs(fps: np.ndarray, block: np.ndarray, difference: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of rows of one block, which are neighbours, whose fingerprints differ in at most so many bits."""
    left, right = [], []
    here = np.arange(len(fps))
    for ahead in range(1, len(fps)):
        here = here[here < len(fps) - ahead]
        here = here[block[here] == block[here + ahead]]
        if not len(here):
            break
        near = here[np.bitwise_count(fps[here] ^ fps[here + ahead]) <= difference]
        left.append(near)
        right.append(near + ahead)
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def smallest_linked(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of ``count`` places the smallest one that the pairs connect it to."""
    lowest = np.arange(count)
    while True:
        low = np.minimum(lowest[left], lowest[right])
        now = lowest.copy()
        for side in (lowest[left], lowest[right], left, right):
            np.minimum.at(now, side, low)
        now = now[now]
        if np.array_equal(now, lowest):
            return lowest
        lowest = now


def _within_blocks(difference: int, size: int):
    """Links inside blocks of a variant, as stars, and the blocks of variants that may have further blocks.

    Those are blocks that are full, that follow another of their variant, or that are the first or last of a task.
    """
    names = ["bit", "rest", "fp"]

    def run(batches):
        task, made, before = TaskContext.get().partitionId() << 33, 0, None
        bit, rest, fps = np.empty(0, np.int8), np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in chain(batches, [None]):
            if batch is not None:
                bit, rest, fps = (
                    np.concatenate([kept, batch.column(name).to_numpy()])
                    for kept, name in zip((bit, rest, fps), names, strict=True)
                )
            if not len(fps):
                continue
            change = np.flatnonzero(np.concatenate([[True], (bit[1:] != bit[:-1]) | (rest[1:] != rest[:-1])]))
            place = np.arange(len(fps)) - np.repeat(change, np.diff(np.append(change, len(fps))))
            starts = np.flatnonzero(place % size == 0)
            ends = np.append(starts[1:], len(fps))
            done = len(starts) if batch is None else len(starts) - 1  # rows to come may belong to the last block
            if not done:
                continue
            end = ends[done - 1]
            yield from _stars(fps[:end], np.repeat(np.arange(done), (ends - starts)[:done]), difference)
            told = (ends - starts == size) | (place[starts] > 0)
            told[0] |= before in (None, (bit[0], rest[0]))
            told[-1] |= batch is None
            rows = [
                (bit[starts[one]], rest[starts[one]], task + made + one, fps[starts[one] : ends[one]].tobytes())
                for one in np.flatnonzero(told[:done]).tolist()
            ]
            if rows:
                yield _variant_rows(None, None, *zip(*rows, strict=True))
            made += done
            before = (bit[starts[done - 1]], rest[starts[done - 1]])
            bit, rest, fps = bit[end:], rest[end:], fps[end:]

    return run


def _stars(fps: np.ndarray, block: np.ndarray, difference: int):
    lowest = smallest_linked(len(fps), *close_pairs(fps, block, difference))
    linked = np.flatnonzero(lowest != np.arange(len(fps)))
    if len(linked):
        yield _variant_rows(fps[lowest[linked]], fps[linked], None, None, None, None)


def _variant_rows(*columns):
    """Rows of links ``a, b`` or of blocks ``bit, rest, block, fps``; the other columns are null."""
    size = max(len(column) for column in columns if column is not None)
    types = [pa.int64(), pa.int64(), pa.int8(), pa.int64(), pa.int64(), pa.binary()]
    arrays = [
        pa.nulls(size, kind) if column is None else pa.array(column, kind)
        for column, kind in zip(columns, types, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, names=["a", "b", "bit", "rest", "block", "fps"])


def _between_blocks(difference: int):
    """Links between two blocks of a variant whose members are in different components."""

    def run(batches):
        for batch in batches:
            found = set()
            for row in range(batch.num_rows):
                sides = []
                for side in ("left", "right"):
                    members = np.frombuffer(batch.column(side)[row].as_buffer(), np.int64).reshape(-1, 2)
                    sides.append((members[:, 0], members[:, 1]))
                found |= linked_components(*sides, difference)
            if found:
                a, b = zip(*sorted(found), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def linked_components(left, right, difference: int) -> set[tuple[int, int]]:
    """Pairs of different components with close fingerprints on two sides (components, fingerprints).

    What both sides have most of is not compared with itself, so a tile inside one large component costs little.
    """
    values, counts = np.unique(np.concatenate([left[0], right[0]]), return_counts=True)
    most = values[counts.argmax()]
    out = set()
    for rows, columns in (
        (left[0] != most, np.ones(len(right[0]), bool)),
        (left[0] == most, right[0] != most),
    ):
        of_row, row = left[0][rows], left[1][rows]
        of_column, column = right[0][columns], right[1][columns]
        near = np.bitwise_count(row[:, None] ^ column[None, :]) <= difference
        near &= of_row[:, None] != of_column[None, :]
        i, j = np.nonzero(near)
        pairs = np.unique(np.stack([of_row[i], of_column[j]], axis=1), axis=0)
        out.update(map(tuple, pairs.tolist()))
    return out


# ---- the operator

def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, difference: int = DIFFERENCE
) -> DataFrame:
    """One row per document: ``doc_id, fingerprint`` (16 hexadecimal digits) and ``component_id``.

    Fingerprints link when they differ in at most ``difference`` bits; the component is the smallest identifier
    reachable by links. Texts without words, null texts included, have the fingerprint zero, which links like any other.
    Equal rows are documents of their own and link; a null identifier is the smallest only where a component has no
    other. An empty table gives no rows; other columns are not read.

    1. Documents of one fingerprint become one class, so copies cost one row per task.
    2. A fingerprint is cut into ``difference // 2 + 1`` segments. Of two that link, one segment differs in at most one
       bit, so they share a variant of a segment with that bit left out: 64 variants each, met by equality.
    3. Variants are sorted by range of (variant, fingerprint), which divides a frequent one over tasks, and cut into
       blocks of 512. All pairs of a block are compared by their bits; its links are told as stars, not as pairs.
    4. Components of those links follow. For a variant of several blocks whose fingerprints are in several components,
       tiles of two blocks compare what is in different components; its blocks are dealt over tasks of 16 blocks each.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("fp", T.LongType())])
    signed = written_once(rows.mapInArrow(_sign(words), schema), "signed")
    classes = written_once(signed.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    labels = class_labels(classes.select("fp"), difference)
    labelled = classes.join(labels, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    lowest = labelled.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = labelled.join(lowest, "component").select("fp", "component_id")
    digits = F.lpad(F.lower(F.hex("fp")), BITS // 4, "0")
    return signed.join(named, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")


def class_labels(classes: DataFrame, difference: int) -> DataFrame:
    """``fp, component`` of all different fingerprints ``fp`` that link to another."""
    keyed = classes.select(F.explode(variant_keys(F.col("fp"), difference)).alias("key"), "fp").select("key.*", "fp")
    order = ("bit", "rest", "fp")
    found = written_once(
        keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
            _within_blocks(difference, BLOCK), "a long, b long, bit tinyint, rest long, block long, fps binary"
        ),
        "variants",
    )
    first = connected_components(found.filter("a IS NOT NULL").select("a", "b"))
    labels = first.select(F.col("vertex").alias("fp"), "component")
    key = ["bit", "rest"]
    blocks = found.filter("fps IS NOT NULL").select(*key, "block", "fps")
    several = blocks.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*key)
    members = blocks.join(several, key).mapInArrow(_members, "bit tinyint, rest long, block long, fp long")
    placed = members.join(labels, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    pair = F.struct("component", "fp")
    sides = written_once(
        placed.groupBy(*key, "block").agg(  # at most BLOCK members
            F.sort_array(F.collect_list(pair)).alias("pairs"), F.min("component").alias("low"),
            F.max("component").alias("high"),
        ),
        "blocks",
    )
    apart = sides.groupBy(*key).agg(
        F.min("low").alias("lowest"), F.max("high").alias("highest"), F.ceil(F.count(F.lit(1)) / TILES).alias("deals")
    ).filter("lowest <> highest").select(*key, "deals")
    if apart.isEmpty():
        return labels
    packed = sides.join(apart, key).mapInArrow(
        _packed, "bit tinyint, rest long, block long, low long, high long, deals long, members binary"
    )
    left = packed.select(
        *key, F.pmod(F.xxhash64("block"), F.col("deals")).alias("deal"),
        *[F.col(name).alias(f"left_{name}") for name in ("block", "low", "high")], F.col("members").alias("left"),
    )
    right = packed.select(
        *key, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("deals") - 1)).alias("deal"), "block", "low", "high",
        F.col("members").alias("right"),
    )
    tiles = left.join(right, [*key, "deal"]).filter(
        "left_block < block AND NOT (left_low = left_high AND low = high AND low = left_low)"
    )
    across = written_once(
        tiles.select("left", "right").mapInArrow(_between_blocks(difference), "a long, b long").distinct(), "across"
    )
    joined = connected_components(across).select(F.col("vertex").alias("component"), F.col("component").alias("root"))
    # a fingerprint without a link inside its blocks is a component of its own that only tiles may join
    single = across.select(F.explode(F.array("a", "b")).alias("fp")).distinct().join(labels, "fp", "left_anti")
    every = labels.unionByName(single.select("fp", F.col("fp").alias("component")))
    return every.join(joined, "component", "left").select("fp", F.coalesce("root", "component").alias("component"))


def _members(batches):
    for batch in batches:
        fps = [np.frombuffer(one.as_buffer(), np.int64) for one in batch.column("fps")]
        sizes = [len(one) for one in fps]
        for first in range(0, len(fps), 64):
            part = slice(first, first + 64)
            at = pa.array(np.repeat(np.arange(first, min(first + 64, len(fps))), sizes[part]))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name).take(at) for name in ("bit", "rest", "block")], pa.array(np.concatenate(fps[part]))],
                names=["bit", "rest", "block", "fp"],
            )


def _packed(batches):
    """Members of a block as bytes: component and fingerprint in turn."""
    names = ["bit", "rest", "block", "low", "high", "deals"]
    for batch in batches:
        bits = []
        for one in batch.column("pairs"):
            flat = one.values.flatten()
            bits.append(np.stack([column.to_numpy() for column in flat], axis=1).tobytes())
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(name) for name in names], pa.array(bits, pa.binary())], names=[*names, "members"]
        )


def op12_simhash_variants(spark, folder):
    return simhash_components(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"))
