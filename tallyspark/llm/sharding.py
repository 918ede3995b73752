"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix."""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.operators.numbering import number_rows
from tallyspark.sources.shared import written_once

ROW_OVERHEAD = 16
MAX_BLOCKS = 512


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` rows taken without replacement are good, by inversion around the mode.

    The probabilities within forty standard deviations of the mode are added up, so it works for counts of any size.
    """
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    total = good + bad
    mode = min(high, max(low, (draws + 1) * (good + 1) // (total + 2)))
    share = good / total
    spread = int(40 * np.sqrt(draws * share * (1 - share) * max(0.0, (total - draws) / max(1, total - 1))) + 50)
    first, last = max(low, mode - spread), min(high, mode + spread)
    k = np.arange(first, last, dtype=np.float64)
    steps = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.cumsum(np.exp(logs - logs.max()))
    return first + int(np.searchsorted(weights, rng.random() * weights[-1], side="right"))


def communication_matrix(block_rows: list[int], shard_rows: list[int], seed: int) -> list[list[int]]:
    """Rows that each block sends to each shard, distributed as under a uniform permutation of all rows."""
    rng = np.random.default_rng(seed)
    left, matrix = list(shard_rows), []
    for rows in block_rows:
        line, open_rows, rest = [], sum(left), rows
        for shard, room in enumerate(left):
            sent = hypergeometric(rng, room, open_rows - room, rest)
            line.append(sent)
            open_rows -= room
            rest -= sent
            left[shard] = room - sent
        matrix.append(line)
    return matrix


def exact_shards(rows: int, n_shards: int) -> list[int]:
    """Shard sizes that differ by one at most."""
    return [rows // n_shards + (shard < rows % n_shards) for shard in range(n_shards)]


def shuffle_into_shards(df: DataFrame, n_shards: int, seed: int = 0) -> DataFrame:
    """All rows and columns of ``df`` plus ``shard`` and ``slot``: a uniform shuffle with exact shard sizes.

    1. The rows are written once with the block (input partition modulo ``MAX_BLOCKS``) and place they were read at.
    2. The counts of the blocks, at most ``MAX_BLOCKS`` numbers, decide a matrix of exact counts.
    3. Each block is permuted by a seeded hash of the place and cut into the runs of its line of the matrix.
    4. The rows are exchanged by shard in a second random order; ``slot`` is the gap-free place in the shard.

    Values play no part, so nulls, ties and repeated rows are ordinary rows, and no key can make a hot task. The same
    seed gives the same result for the same input partitions. An empty table gives no rows. Where ``df`` has columns
    called ``shard`` or ``slot``, they are replaced.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    kept = [name for name in df.columns if name not in ("shard", "slot")]
    place = F.monotonically_increasing_id()
    stored = written_once(
        df.select(
            F.struct(*[F.col(f"`{name}`") for name in kept]).alias("row"), place.alias("place"),
            (F.spark_partition_id() % MAX_BLOCKS).alias("block"),
        ),
        "shard-input",
    )
    counts = {block: rows for block, rows in stored.groupBy("block").count().collect()}  # at most MAX_BLOCKS rows
    block_rows = [counts.get(block, 0) for block in range(max(counts, default=0) + 1)]
    sizes = exact_shards(sum(block_rows), n_shards)
    matrix = communication_matrix(block_rows, sizes, seed)
    ends = np.cumsum(np.array(matrix, dtype=np.int64), axis=1).tolist()
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).tolist()

    local = Window.partitionBy("block").orderBy(_drawn(seed, 1), "place")
    sent = (
        stored.withColumn("rank", F.row_number().over(local) - 1)
        .withColumn("shard", _first_above(ends, F.col("block"), F.col("rank")))
        .withColumn("draw", _drawn(seed, 2))
    )
    numbered = number_rows(sent.select("row", "place", "shard", "draw"), ["shard", "draw", "place"], "number", start=0)
    first = F.element_at(_literal(starts, "array<bigint>"), F.col("shard") + 1)
    return numbered.select(
        *[F.col("row")[name].alias(name) for name in kept], "shard", (F.col("number") - first).alias("slot")
    )


def _drawn(seed: int, turn: int) -> Column:
    return F.xxhash64(F.lit(seed), F.lit(turn), F.col("place"))


def _literal(values, kind: str) -> Column:
    """Bounded numbers as one literal: blocks times shards at most."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def _first_above(ends, block: Column, rank: Column) -> Column:
    """The shard whose run of the block holds the rank."""
    line = F.element_at(_literal(ends, "array<array<bigint>>"), block + 1)
    return F.size(F.filter(line, lambda end: end <= rank)).cast("int")


def op3_hypergeometric_sharding(spark, folder):
    """All documents in 40 shards under the law ``rows``; a uniform shuffle has no groups to keep together."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        "doc_id", (F.octet_length(text) + ROW_OVERHEAD).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return shuffle_into_shards(narrow, 40, seed=17).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
