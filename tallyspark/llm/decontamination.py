"""Benchmark decontamination: a broadcast set of test n-grams against every word window of every document."""

from __future__ import annotations

import json
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.sources.shared import written_once

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WINDOW_WORDS = 10
BITS_PER_WINDOW = 64
PROBES = 4  # 1 in 65,000 windows that are not in the benchmark has all bits set
MOST_LONGS = 1 << 21  # of the bit set that every task holds: 16 MB at most, whatever the benchmark


def word_list(text: Column) -> Column:
    """Words of a text after lower-casing A-Z only: runs of digits, letters and anything beyond ASCII."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, SEPARATORS + "+"), "")


def benchmark_windows(
    benchmark: DataFrame, size: int = WINDOW_WORDS, item_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """One row per different window: ``window`` (its words), ``length`` and ``items`` (item ids as strings).

    An item of fewer words than ``size`` is one window; an item without words has none. Items with a null identifier
    mark words but are not listed.
    """
    words = benchmark.select(F.col(item_col).cast("string").alias("item"), word_list(F.col(text_col)).alias("words"))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (size - 1)))
    windows = words.filter(F.size("words") > 0).select(
        "item", F.explode(F.transform(starts, lambda at: F.slice("words", at, size))).alias("window")
    )
    return windows.groupBy("window").agg(F.collect_set("item").alias("items")).withColumn("length", F.size("window"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, id_col: str = "doc_id", text_col: str = "text",
    most_longs: int = MOST_LONGS,
) -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, n_items, items, contaminated``.

    A word is hit when it lies in any occurrence of a benchmark window. A null or empty text has no words; repeated
    rows and repeated or null identifiers give one row each; an empty benchmark hits nothing.
    """
    windows = written_once(benchmark_windows(benchmark, size), "windows")
    found = _with_hits(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), windows, most_longs)
    return _verified(found.select("uid", "doc_id", "n_words", "hits"), windows).drop("uid", "spans")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, remove: str = "documents", size: int = WINDOW_WORDS,
    text_col: str = "text", most_longs: int = MOST_LONGS,
) -> DataFrame:
    """The documents with all their columns, without contaminated documents or (``remove='spans'``) without hit words.

    A removed span takes the separators before each of its words along. Documents without a hit go through untouched
    and unshuffled, nulls included.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be documents or spans, not {remove}")
    windows = written_once(benchmark_windows(benchmark, size), "windows")
    rows = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"))
    stored = written_once(_with_hits(rows.withColumn("text", F.col("row")[text_col]), windows, most_longs), "hits")
    clean = stored.filter(F.size("hits") == 0).select("row")
    dirty = stored.filter(F.size("hits") > 0)
    marked = _verified(dirty.select("uid", F.lit(None).cast("bigint").alias("doc_id"), "n_words", "hits"), windows)
    joined = dirty.select("uid", "row").join(marked.select("uid", "n_hit", "spans"), "uid")
    if remove == "documents":
        joined = joined.filter("n_hit = 0")
        rest = joined.select("row")
    else:
        cleaned = _without_spans(F.col("row")[text_col], F.col("spans"))
        rest = joined.select(F.col("row").withField(text_col, cleaned).alias("row"))
    return clean.unionByName(rest).select(*[F.col("row")[name].alias(name) for name in docs.columns])


def _probes(value: Column, longs: int) -> list[Column]:
    """Places in a set of so many 64-bit numbers, a power of two: steps of one half of a hash from the other."""
    last = F.lit(64 * longs - 1).cast("bigint")
    start, step = value.bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(value, 32)
    return [(start + turn * step).bitwiseAND(last) for turn in range(PROBES)]


def window_bits(windows: DataFrame, longs: int) -> Column:
    """The hash set of the windows as an array of numbers whose bits are set, a constant of the query."""
    places = windows.select(F.explode(F.array(*_probes(F.xxhash64("window"), longs))).alias("place"))
    number, bit = F.shiftright("place", 6), F.col("place").bitwiseAND(F.lit(63)).cast("int")
    set_bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    numbers = [0] * longs
    for row in places.groupBy(number.alias("number")).agg(F.bit_or(set_bit).alias("bits")).toLocalIterator():
        numbers[row.number] = row.bits  # as many as the set has numbers, at most
    return F.from_json(F.lit(json.dumps(numbers)), "array<bigint>")


def _with_hits(rows: DataFrame, windows: DataFrame, most_longs: int) -> DataFrame:
    """Rows plus ``uid``, ``n_words`` and ``hits``: windows of the text whose hash may be in the set of the benchmark.

    The set goes to every task as bits: 64 for each window of the benchmark, and never more than ``most_longs`` numbers.
    Every window of a text is looked up at four bits; what is found is verified by its words in a join. A benchmark too
    large for the bits gives more to verify, not another way.
    """
    known = windows.agg(F.count(F.lit(1)), F.array_sort(F.collect_set("length"))).first()  # lengths: up to the size
    longs = 1
    while longs < most_longs and longs * 64 < known[0] * BITS_PER_WINDOW:
        longs *= 2
    bits = window_bits(windows, longs)

    def found(value: Column) -> Column:
        tests = [
            F.getbit(
                F.element_at(bits, (F.shiftright(place, 6) + 1).cast("int")), place.bitwiseAND(F.lit(63)).cast("int")
            ) == 1
            for place in _probes(value, longs)
        ]
        return reduce(and_, tests)

    listed = rows.withColumn("words", word_list(F.col("text"))).withColumn("n_words", F.size("words").cast("bigint"))
    hits = F.array().cast("array<struct<at:int,length:int,window:array<string>>>")
    for length in known[1]:
        starts = F.when(F.col("n_words") >= length, F.sequence(F.lit(1), F.size("words") - (length - 1))).otherwise(
            F.array().cast("array<int>")
        )
        candidates = F.filter(_hashed(starts, length), lambda one: found(one["hash"]))
        hits = F.concat(hits, F.transform(candidates, _told(length)))
    return listed.withColumns({"hits": hits, "uid": F.monotonically_increasing_id()}).drop("words", "text")


def _hashed(starts: Column, length: int) -> Column:
    return F.transform(
        starts, lambda at: F.struct(at.alias("at"), F.xxhash64(F.slice("words", at, length)).alias("hash"))
    )


def _told(length: int):
    def told(one: Column) -> Column:
        return F.struct(
            one["at"].alias("at"), F.lit(length).alias("length"), F.slice("words", one["at"], length).alias("window")
        )

    return told


def _verified(found: DataFrame, windows: DataFrame) -> DataFrame:
    """Compare the words of each hit with those of the windows, then join overlapping hits of a document."""
    hits = found.select("uid", "doc_id", "n_words", F.explode_outer("hits").alias("hit")).select(
        "uid", "doc_id", "n_words", "hit.at", "hit.length", "hit.window"
    )
    checked = hits.join(windows.select("window", "items"), "window", "left")
    true_hit = F.when(F.col("items").isNotNull(), F.struct("at", "length"))
    single = checked.select("uid", "doc_id", "n_words", true_hit.alias("span"), F.explode_outer("items").alias("item"))
    merged = single.groupBy("uid", "doc_id", "n_words").agg(  # sets: items of one template do not multiply them
        F.array_sort(F.collect_set("span")).alias("spans"), F.array_sort(F.collect_set("item")).alias("items")
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("bigint").alias("words"), F.lit(0).alias("end")),
        lambda done, span: F.struct(
            (
                done["words"]
                + F.greatest(F.lit(0), span["at"] + span["length"] - F.greatest(done["end"] + 1, span["at"]))
            ).cast("bigint").alias("words"),
            F.greatest(done["end"], span["at"] + span["length"] - 1).alias("end"),
        ),
    )["words"]
    return merged.withColumn("n_hit", covered).select(
        "uid", "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), "items", "spans",
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _without_spans(text: Column, spans: Column) -> Column:
    pieces = F.regexp_extract_all(text, F.lit(f"{SEPARATORS}*{WORD}+"), F.lit(0))
    tail = F.regexp_extract(text, f"({SEPARATORS}*)\\z", 1)
    kept = F.filter(
        pieces,
        lambda piece, place: ~F.exists(
            spans, lambda span: (place + 1 >= span["at"]) & (place + 1 < span["at"] + span["length"])
        ),
    )
    return F.concat(F.array_join(kept, ""), tail)


SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS uid, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
    SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS win
    FROM (SELECT item, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM b WHERE len(w) > 0)),
dw AS (
    SELECT uid, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
    FROM (SELECT uid, w, n, unnest(range(1, len(w) - n + 2)) AS i
          FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
h AS (SELECT uid, dw.n, i, item FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
c AS (SELECT uid, count(DISTINCT p) AS n_hit
      FROM (SELECT uid, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT uid, i, n FROM h)) GROUP BY uid),
t AS (SELECT uid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
      FROM (SELECT DISTINCT uid, item FROM h) GROUP BY uid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (uid) LEFT JOIN t USING (uid)"""


def op4_benchmark_decontamination(spark, folder):
    found = contamination(
        spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    )
    return found.withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256)).drop("items")
