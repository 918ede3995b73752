"""Jaccard join on word n-grams: size-banded tiles, bitmap bounds, exact intersections, components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.components import connected_components
from tallyspark.sources.shared import small_batches, written_once

WORDS = 5
PERCENT = 80
FIRST_KEYS = 8  # keys of a set that look for likely partners before the full search
NEIGHBOURS = 8  # places ahead, in order of size under a key, to which a set is compared first
PARTNERS = 4  # partners of a set that are verified at a time, growing eightfold each time
SKETCH_BITS = 20  # buckets in which all sets count their hashes, so that frequent ones come last in the common order
CHUNK = 1 << 16  # buckets per row of a task's counts
HELD_PAIRS = 1 << 20  # pairs a task holds to give each once
PLACE_BITS = 31  # of a place in a prefix, beside the size of the set
BLOCK = 512  # rows of one key on one side of a tile
SMALL_BITS = 1024
BROADCAST_KEYS = 500_000  # identifiers (8 bytes each) up to which the sets to be read again are told to every task


# ---- sets of one text

def shingles(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Sorted different 64-bit hashes of the word n-grams; a shorter text is one n-gram, no words give none.

    Words are separated by space and 0x09 to 0x0D, as ``bytes.split`` does; ``bytes.lower`` touches A-Z only.
    """
    found = text.lower().split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    hashed = xxhash.xxh3_64_intdigest
    count = max(1, len(found) - words + 1)
    return np.unique(np.array([hashed(b" ".join(found[at : at + words])) for at in range(count)], np.uint64))


def in_order(hashes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Hashes of a set in the common order of all sets: rarer levels first, then by value."""
    return hashes[np.argsort(levels[_bucket(hashes)], kind="stable")]


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def levels_of(counts: np.ndarray) -> np.ndarray:
    """Coarse frequency of each bucket of the sketch: 0 up to what chance puts there, then one more per doubling."""
    usual = counts.mean()
    limit = usual + 6 * np.sqrt(usual) + 8
    return np.ceil(np.log2(np.maximum(counts, limit) / limit)).astype(np.uint8)


def prefix_length(size: int, percent: int = PERCENT) -> int:
    """So many of the first hashes of a set: two sets this similar share one of them, whatever the common order is."""
    return size - (percent * size + 99) // 100 + 1 if size else 0


def bitmap(hashes: np.ndarray) -> bytes:
    """Parities of the hashes modulo the width, which grows with the set."""
    width = SMALL_BITS
    while width < 2 * len(hashes):
        width *= 2
    counts = np.bincount((hashes % np.uint64(width)).astype(np.int64), minlength=width)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def possible(sizes_a, sizes_b, differing, percent: int = PERCENT):
    """Whether sets of these sizes, whose bitmaps differ in so many bits, can be similar enough.

    Every differing bit needs an element that only one set has, which bounds the overlap from above.
    """
    overlap = (sizes_a + sizes_b - differing) // 2
    return 100 * overlap >= percent * (sizes_a + sizes_b - overlap)


def folded(bits: list[bytes]) -> np.ndarray:
    """All bitmaps folded to the smallest width, one row each: parities modulo a divisor are parities again."""
    out = np.empty((len(bits), SMALL_BITS // 64), np.uint64)
    small = SMALL_BITS // 8
    plain = [place for place, one in enumerate(bits) if len(one) == small]
    if plain:
        out[plain] = np.frombuffer(b"".join([bits[place] for place in plain]), np.uint64).reshape(len(plain), -1)
    for place, one in enumerate(bits):
        if len(one) != small:
            out[place] = _fold(np.frombuffer(one, np.uint64), SMALL_BITS // 64)
    return out


def _fold(words: np.ndarray, width: int) -> np.ndarray:
    return np.bitwise_xor.reduce(words.reshape(-1, width), axis=0)


def differing_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of the rows of two matrices of folded bitmaps."""
    out = np.empty(len(a), np.int64)
    for first in range(0, len(a), 1 << 15):
        part = slice(first, first + (1 << 15))
        out[part] = np.bitwise_count(a[part] ^ b[part]).sum(axis=1, dtype=np.int64)
    return out


def differing_bits_of(a: bytes, b: bytes) -> int:
    """Differing bits of two bitmaps at the width of the narrower one."""
    one, other = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    width = min(len(one), len(other))
    return int(np.bitwise_count(_fold(one, width) ^ _fold(other, width)).sum())


def bounded_pairs(n: np.ndarray, bits: list[bytes], small: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int):
    """Of the pairs of rows ``a, b``, those that their bitmaps leave, and the part of their elements that differs."""
    differ = differing_bits(small[a], small[b])
    kept = np.flatnonzero(possible(n[a], n[b], differ, percent))
    a, b, differ = a[kept], b[kept], differ[kept]
    narrow = SMALL_BITS // 8
    wide = [place for place, (x, y) in enumerate(zip(a, b, strict=True)) if len(bits[x]) > narrow < len(bits[y])]
    for place in wide:
        differ[place] = differing_bits_of(bits[a[place]], bits[b[place]])
    kept = np.flatnonzero(possible(n[a], n[b], differ, percent))
    a, b, differ = a[kept], b[kept], differ[kept]
    return a, b, differ / (n[a] + n[b])


def may_start(n_a, place_a, n_b, place_b, percent: int):
    """Whether the first hash that two sets share can be at these places of them, if they are similar enough.

    What comes before is not shared, so the overlap is what comes after, at most.
    """
    overlap = np.minimum(n_a - place_a, n_b - place_b)
    return 100 * overlap >= percent * (n_a + n_b - overlap)


# ---- the join

def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id`` (smallest identifier reachable by links).

    Two documents link when ``100 * intersection >= percent * union`` of their sets of word n-grams. Documents
    without words, null texts included, have an empty set and are linked with nothing. Repeated rows are documents of
    their own and link; a null identifier is the smallest only where a component has no other. An empty table gives no
    rows; other columns are not read.

    1. Equal sets become one class, so copies cost one row per task.
    2. Likely partners from a few keys are bounded by bitmaps and verified, which joins most groups.
    3. Every class goes to the keys of its prefix: the first hashes in an order common to all sets, of which similar
       sets share one. A sketch of fixed size counts the hashes of all documents, and hashes that many share come last
       in that order, so a passage that a third of all documents hold is in few prefixes. Keys whose
       classes are all in one component are done; the others are cut, in order of size, into tiles, whose bitmaps
       bound every pair of two components; no pair is left out.
    4. What the bounds leave is verified by intersecting the sorted sets, best bounds first, until every pair that is
       left lies in one component.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    with small_batches(docs.sparkSession):
        signed = written_once(_signed(rows, words), "signed")
        join = _Join(rows, _levels(signed), words, percent)
    labelled = join.classes.select("cid", "fp", "rep").join(join.labels(), "cid", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "cid"))
    lowest = labelled.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = written_once(labelled.join(lowest, "component").select("fp", "component_id"), "class-components")
    own = signed.filter("chunk IS NULL").select("doc_id", "n_shingles", "fp")
    return own.join(named, "fp", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def keep_one_per_component(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """The documents with all their columns, one per component: the row of the smallest identifier.

    Where rows share that identifier, or identifiers are null, one of the component's rows stays all the same: then
    the rows are stored with their places, which stand for the identifiers. Otherwise the identifiers of the rows to
    drop are all that is joined, broadcast where they are few enough to be (counted on their stored table).
    """
    times = docs.groupBy(F.col(f"`{id_col}`").alias("id")).agg(F.count(F.lit(1)).alias("times"))
    if times.filter("times > 1 OR id IS NULL").isEmpty():
        grouped = jaccard_components(docs, id_col, text_col, words, percent)
        dropped = written_once(
            grouped.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(id_col)), "dropped"
        )
        side = F.broadcast(dropped) if dropped.count() <= BROADCAST_KEYS else dropped
        return docs.join(side, id_col, "left_anti").select(*[F.col(f"`{name}`") for name in docs.columns])
    place = F.monotonically_increasing_id()
    stored = written_once(
        docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"), place.alias("place")), "rows"
    )
    # the place stands for the identifier: in order of (identifier, place) it has a unique smallest row per component
    keyed = stored.select(F.col("row")[id_col].alias("id"), "place", F.col("row")[text_col].alias("text"))
    grouped = jaccard_components(
        keyed.select(F.struct(F.col("id").isNull().alias("missing"), "id", "place").alias("doc_id"), "text"),
        words=words, percent=percent,
    )
    first = grouped.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id.place").alias("place"))
    return stored.join(first, "place", "left_semi").select(
        *[F.col("row")[name].alias(name) for name in docs.columns]
    )


def _signed(rows: DataFrame, words: int) -> DataFrame:
    """``doc_id, n_shingles, fp`` per document (no ``fp`` for an empty set), and per task rows of ``chunk, counts``."""
    schema = T.StructType(
        [
            T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("n_shingles", T.LongType()),
            T.StructField("fp", T.BinaryType()), T.StructField("chunk", T.IntegerType()), T.StructField("counts", T.BinaryType()),
        ]
    )

    def sign(batches):
        counts, id_type = np.zeros(1 << SKETCH_BITS, np.uint32), None
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            sizes, prints = [], []
            for text in batch.column("text").cast(pa.binary()):
                hashes = shingles(text.as_py(), words)
                sizes.append(len(hashes))
                prints.append(_fingerprint(hashes))
                np.add.at(counts, _bucket(hashes), 1)
            nothing = pa.nulls(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()),
                    nothing.cast(pa.int32()), nothing.cast(pa.binary()),
                ],
                names=["doc_id", "n_shingles", "fp", "chunk", "counts"],
            )
        if id_type is not None:
            pieces = counts.astype("<u4").reshape(-1, CHUNK)
            nothing = pa.nulls(len(pieces))
            yield pa.RecordBatch.from_arrays(
                [
                    nothing.cast(id_type), nothing.cast(pa.int64()), nothing.cast(pa.binary()),
                    pa.array(range(len(pieces)), pa.int32()), pa.array([piece.tobytes() for piece in pieces], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "fp", "chunk", "counts"],
            )

    return rows.mapInArrow(sign, schema)


def _levels(signed: DataFrame) -> np.ndarray:
    """Levels of all buckets: a sum per chunk over the tasks, then one number per bucket on the driver (8 MB)."""

    def add(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts"), strict=True):
                one = np.frombuffer(counts.as_py(), "<u4").astype(np.int64)
                totals[chunk] = totals[chunk] + one if chunk in totals else one
        if totals:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(totals), pa.int32()), pa.array([one.tobytes() for one in totals.values()], pa.binary()),
                ],
                names=["chunk", "total"],
            )

    pieces = signed.filter("chunk IS NOT NULL").select("chunk", "counts").repartition("chunk")
    counts = np.zeros((1 << SKETCH_BITS) // CHUNK * CHUNK, np.int64).reshape(-1, CHUNK)
    for row in pieces.mapInArrow(add, "chunk int, total binary").collect():  # one row per chunk
        counts[row.chunk] = np.frombuffer(row.total, np.int64)
    return levels_of(counts.ravel())


def _fingerprint(hashes: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None


class _Join:
    def __init__(self, rows: DataFrame, levels: np.ndarray, words: int, percent: int):
        self.rows, self.words, self.percent = rows, words, percent
        self.levels = rows.sparkSession.sparkContext.broadcast(levels)
        self.classes = self._make_classes()
        self.links = None  # of which the labels do not know yet
        self._labels = None
        self._search()

    def labels(self) -> DataFrame:
        """``cid, component`` of the classes that have a link; links that are new are joined to the components so far."""
        if self.links is not None:
            edges = self.links
            if self._labels is not None:
                edges = edges.union(self._labels.select("cid", "component"))
            found = connected_components(edges)
            self._labels, self.links = written_once(found.withColumnRenamed("vertex", "cid"), "labels"), None
        if self._labels is None:
            return self.classes.sparkSession.createDataFrame([], "cid long, component long")
        return self._labels

    def _make_classes(self) -> DataFrame:
        """One row per different set: number, fingerprint, smallest identifier, size, prefix, smallest hashes, bitmap."""
        words, percent, shared = self.words, self.percent, self.levels
        schema = T.StructType(
            [
                self.rows.schema["doc_id"], T.StructField("fp", T.BinaryType()), T.StructField("n", T.LongType()),
                T.StructField("prefix", T.ArrayType(T.LongType())), T.StructField("lowest", T.ArrayType(T.LongType())),
                T.StructField("bits", T.BinaryType()),
            ]
        )

        def make(batches):
            levels = shared.value
            for batch in batches:
                keys, prints, sizes, prefixes, lowest, bits = [], [], [], [], [], []
                for place, text in enumerate(batch.column("text").cast(pa.binary())):
                    hashes = shingles(text.as_py(), words)
                    if not len(hashes):
                        continue
                    keys.append(place)
                    prints.append(_fingerprint(hashes))
                    sizes.append(len(hashes))
                    ordered = in_order(hashes, levels)
                    prefixes.append(ordered[: prefix_length(len(hashes), percent)].astype(np.int64))
                    lowest.append(hashes[:FIRST_KEYS].astype(np.int64))
                    bits.append(bitmap(hashes))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(keys, pa.int32())), pa.array(prints, pa.binary()),
                        pa.array(sizes, pa.int64()), pa.array(prefixes, pa.list_(pa.int64())),
                        pa.array(lowest, pa.list_(pa.int64())), pa.array(bits, pa.binary()),
                    ],
                    names=["doc_id", "fp", "n", "prefix", "lowest", "bits"],
                )

        made = self.rows.mapInArrow(make, schema)
        grouped = made.groupBy("fp").agg(
            F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("prefix").alias("prefix"),
            F.first("lowest").alias("lowest"), F.first("bits").alias("bits"),
        )
        return written_once(grouped.withColumn("cid", F.monotonically_increasing_id()), "classes")

    def _search(self) -> None:
        likely = self._bounded(self._likely_pairs())
        self._verify_in_turn(likely)
        rest = written_once(self._tile_pairs(), "pairs")
        self._verify_in_turn(rest)

    # ---- candidates

    def _likely_pairs(self) -> DataFrame:
        """Sets that follow each other in size under a few shared keys, up to ``NEIGHBOURS`` places apart.

        This only saves work later: what a batch of rows does not show here, the full search finds.
        """
        percent = self.percent
        keyed = self.classes.select("cid", "n", F.explode("lowest").alias("key"))
        # a range of (key, size) per task, so that a key that many sets share is divided
        ordered = keyed.repartitionByRange("key", "n", "cid").sortWithinPartitions("key", "n", "cid")

        def pair(batches):
            for batch in batches:
                key, n, cid = (batch.column(name).to_numpy() for name in ("key", "n", "cid"))
                found = []
                for ahead in range(1, min(NEIGHBOURS + 1, len(key))):
                    near = (key[ahead:] == key[:-ahead]) & (percent * n[ahead:] <= 100 * n[:-ahead])
                    found.append(np.stack([cid[ahead:][near], cid[:-ahead][near]]))
                if found:
                    pairs = np.concatenate(found, axis=1)
                    pairs = np.unique(np.stack([pairs.max(axis=0), pairs.min(axis=0)]), axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

        return ordered.mapInArrow(pair, "a long, b long").filter("a <> b").distinct()

    def _bounded(self, pairs: DataFrame) -> DataFrame:
        """Pairs that the bitmaps leave, with the bound of the overlap."""
        percent = self.percent
        side = self.classes.select("cid", "n", "bits")
        joined = pairs.join(side.toDF("a", "n_a", "bits_a"), "a").join(side.toDF("b", "n_b", "bits_b"), "b")

        def bound(batches):
            for batch in batches:
                n = np.concatenate([batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()])
                bits = batch.column("bits_a").to_pylist() + batch.column("bits_b").to_pylist()
                here = np.arange(batch.num_rows)
                kept, _, share = bounded_pairs(n, bits, folded(bits), here, here + batch.num_rows, percent)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("a").take(pa.array(kept)), batch.column("b").take(pa.array(kept)),
                        pa.array(share, pa.float64()),
                    ],
                    names=["a", "b", "share"],
                )

        kept = joined.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(bound, "a long, b long, share double")
        return written_once(kept, "pairs")

    def _tile_pairs(self) -> DataFrame:
        """All pairs of two components that share a key of both prefixes and that the bitmaps leave."""
        percent = self.percent
        marked = self.classes.select("cid", "n", "prefix").join(self.labels(), "cid", "left")
        keyed = marked.select(
            "cid", (F.coalesce("component", "cid") - F.col("cid")).alias("to_component"), "n",
            F.posexplode("prefix").alias("place", "key"),
        )
        # size and place in one number, and the component as a difference that is mostly 0, keep the shuffle small
        sized = (F.shiftleft(F.col("n"), PLACE_BITS) + F.col("place")).alias("sized")
        small = keyed.select("key", sized, "cid", "to_component")
        # a range of (key, size) per task: a frequent key is divided, and its blocks never cross the limit of a range
        blocks = small.repartitionByRange("key", "sized", "cid").sortWithinPartitions("key", "sized", "cid").mapInArrow(
            _blocks(percent), "key long, block long, n long, place int, cid long, component long, whole boolean"
        )
        tiled = self._tiled(written_once(blocks, "blocks"))
        rows = tiled.join(self.classes.select("cid", "bits"), "cid")
        tile = ["key", "first", "second"]
        ordered = rows.select(*tile, "block", "n", "place", "cid", "component", "bits").repartition(*tile)
        pairs = ordered.sortWithinPartitions(*tile, "n", "cid").mapInArrow(
            _compare(percent), "a long, b long, share double"
        )
        return pairs.distinct()

    def _tiled(self, rows: DataFrame) -> DataFrame:
        """Rows in tiles: a whole key is one, of a key in several blocks each two blocks that can hold a pair are one.

        Only summaries of blocks are paired, and rows joined to the tiles of their block, so the tiles of a frequent key
        are made by many tasks and held by none.
        """
        columns = ["n", "place", "cid", "component"]
        one = F.lit(0).cast("long")
        whole = rows.filter("whole").select(
            "key", one.alias("first"), one.alias("second"), one.alias("block"), *columns
        )
        parts = rows.filter("NOT whole")
        held = parts.groupBy("key", "block").agg(
            F.min("n").alias("n_from"), F.max("n").alias("n_to"), F.min("component").alias("c_from"),
            F.max("component").alias("c_to"), F.max(F.col("n") - F.col("place")).alias("rest"),
        )
        held = written_once(held, "block-ranges")
        left = held.select("key", *[F.col(name).alias(f"{name}_a") for name in held.columns[1:]])
        right = held.select("key", *[F.col(name).alias(f"{name}_b") for name in held.columns[1:]])
        # blocks go up in size, so the sizes nearest to each other are the last of one and the first of the other
        may = F.lit(100) * F.col("n_to_a") >= F.lit(self.percent) * F.col("n_from_b")
        overlap = F.least("rest_a", "rest_b")
        start = 100 * overlap >= self.percent * (F.col("n_from_a") + F.col("n_from_b") - overlap)  # as may_start
        mixed = F.least("c_from_a", "c_from_b") < F.greatest("c_to_a", "c_to_b")
        tiles = left.join(right, "key").filter((F.col("block_a") <= F.col("block_b")) & may & start & mixed)
        tiles = tiles.select("key", F.col("block_a").alias("first"), F.col("block_b").alias("second"))
        sides = tiles.withColumn("block", F.explode(F.array_distinct(F.array("first", "second"))))
        joined = parts.join(sides, ["key", "block"])
        return whole.unionByName(joined.select("key", "first", "second", "block", *columns))

    # ---- verification

    def _verify_in_turn(self, pairs: DataFrame) -> None:
        """Verify pairs between components, the closest partners of each class first, until none is left."""
        width, left = PARTNERS, pairs
        while True:
            apart = left
            if self.links is not None or self._labels is not None:
                label = self.labels()
                apart = (
                    left.join(label.toDF("a", "of_a"), "a", "left").join(label.toDF("b", "of_b"), "b", "left")
                    .filter(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b", "share")
                )
            closest = Window.partitionBy("a").orderBy("share", "b")
            ranked = written_once(apart.withColumn("rank", F.row_number().over(closest)), "ranked")
            chosen = ranked.filter(F.col("rank") <= width)
            if chosen.isEmpty():
                return
            links = written_once(self._verified(chosen.select("a", "b")), "links")
            if not links.isEmpty():
                self.links = links  # `labels` has taken those before
            left = ranked.filter(F.col("rank") > width).drop("rank")
            width *= 8

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose sets, read again from the texts, are similar enough."""
        words, percent = self.words, self.percent
        wanted = pairs.select(F.col("a").alias("cid")).union(pairs.select(F.col("b").alias("cid"))).distinct()
        told = written_once(wanted.join(self.classes.select("cid", "fp", "rep"), "cid"), "wanted")
        if told.count() <= BROADCAST_KEYS:
            told = F.broadcast(told)
        texts = self.rows.join(told, F.col("doc_id").eqNullSafe(F.col("rep"))).select("cid", "fp", "text")

        def read(batches):
            for batch in batches:
                kept, sets = [], []
                prints = batch.column("fp").to_pylist()
                for place, text in enumerate(batch.column("text").cast(pa.binary())):
                    hashes = shingles(text.as_py(), words)
                    if _fingerprint(hashes) == prints[place]:
                        kept.append(place)
                        sets.append(hashes.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("cid").take(pa.array(kept, pa.int32())), pa.array(sets, pa.binary())],
                    names=["cid", "hashes"],
                )

        read_again = texts.mapInArrow(read, "cid long, hashes binary")
        sets = written_once(read_again.groupBy("cid").agg(F.first("hashes").alias("hashes")), "sets")
        both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")

        def intersect(batches):
            for batch in batches:
                kept = []
                pairs = zip(batch.column("set_a"), batch.column("set_b"), strict=True)
                for place, (a, b) in enumerate(pairs):
                    a, b = np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)
                    common = len(np.intersect1d(a, b, assume_unique=True))
                    if 100 * common >= percent * (len(a) + len(b) - common):
                        kept.append(place)
                kept = pa.array(kept, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a").take(kept), batch.column("b").take(kept)], names=["a", "b"]
                )

        return both.select("a", "b", "set_a", "set_b").mapInArrow(intersect, "a long, b long")


def _whole_runs(batches, keys: list[str]):
    """Sorted batches cut anew so that no run of equal keys is divided: tables and the starts of their runs."""

    def starts_of(table):
        changed = np.zeros(table.num_rows, bool)
        changed[0] = True
        for name in keys:
            column = table.column(name).to_numpy()
            changed[1:] |= column[1:] != column[:-1]
        return np.flatnonzero(changed)

    held: list[pa.Table] = []  # rows of the last key so far
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        starts = starts_of(table)
        first_key = [table.column(name)[0].as_py() for name in keys]
        if held and (first_key != last or len(starts) > 1):
            if first_key == last:
                held.append(table.slice(0, int(starts[1])))
                table, starts = table.slice(int(starts[1])), starts[1:] - starts[1]
            whole = pa.concat_tables(held)
            yield whole, starts_of(whole)
            held = []
        if len(starts) > 1:
            yield table.slice(0, int(starts[-1])), starts[:-1]
            table = table.slice(int(starts[-1]))
        held.append(table)
        last = [table.column(name)[0].as_py() for name in keys]
    if held:
        whole = pa.concat_tables(held)
        yield whole, starts_of(whole)


def _pairs_ahead(table: pa.Table, starts: np.ndarray, percent: int):
    """Pairs of rows of one run, in arrays: each row with those one, two, three ... places ahead.

    Only pairs of two components are given whose sizes allow the similarity and which can share their first hash here.
    """
    if not table.num_rows:
        return
    n, place, component = (table.column(name).to_numpy() for name in ("n", "place", "component"))
    ends = np.repeat(np.append(starts[1:], len(n)), np.diff(np.append(starts, len(n))))
    here, ahead = np.arange(len(n)), 1
    while True:
        here = here[here + ahead < ends[here]]
        here = here[percent * n[here + ahead] <= 100 * n[here]]  # sizes go up, so farther ones differ more
        if not len(here):
            return
        there = here + ahead
        fit = component[here] != component[there]
        a, b = here[fit], there[fit]
        fit = may_start(n[a], place[a], n[b], place[b], percent)
        if fit.any():
            yield a[fit], b[fit]
        ahead += 1


def _blocks(percent: int):
    """Sorted rows in blocks; keys that lie whole in a task and in one block keep only rows that have a partner.

    A task holds one batch and one block. Whether a key at the limits of a task goes on in another is not known, so
    its rows all stay and are paired with other blocks.
    """

    def run(batches):
        task, number = TaskContext.get().partitionId() << 32, 0
        held: list[pa.Table] = []  # rows of the key at the end of what was read, fewer than a block
        open_key, begun, first_key = None, False, None  # begun: blocks of that key were given

        def given(table, block, whole):
            block = np.asarray(block, np.int64) + np.zeros(table.num_rows, np.int64)
            columns = table.select(["key", "n", "place", "cid", "component"])
            made = {"block": block, "whole": np.full(table.num_rows, whole)}
            names = ["key", "block", "n", "place", "cid", "component", "whole"]
            columns = {name: columns[name] for name in columns.column_names} | made
            return pa.table({name: columns[name] for name in names}).to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            sized, cid = table["sized"].to_numpy(), table["cid"].to_numpy()
            table = pa.table(
                {
                    "key": table["key"], "n": sized >> PLACE_BITS,
                    "place": (sized & ((1 << PLACE_BITS) - 1)).astype(np.int32), "cid": cid,
                    "component": cid + table["to_component"].to_numpy(),
                }
            )
            key = table["key"].to_numpy()
            if first_key is None:
                first_key = open_key = int(key[0])
            if held:
                table = pa.concat_tables([*held, table])
                key, held = table["key"].to_numpy(), []
            starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            ends = np.append(starts[1:], len(key))
            alone = (ends - starts <= BLOCK) & (key[starts] != first_key)
            alone[0] &= not (begun and key[0] == open_key)
            alone[-1] = False  # it may go on
            for start, end in zip(starts[~alone].tolist(), ends[~alone].tolist(), strict=True):
                last = end == len(key)
                at = start
                while end - at > (BLOCK if last else 0):
                    yield from given(table.slice(at, min(BLOCK, end - at)), task + number, False)
                    number, at = number + 1, at + min(BLOCK, end - at)
                if last:
                    held = [table.slice(at, end - at).combine_chunks()]
                    open_key, begun = int(key[-1]), at > start or (begun and int(key[-1]) == open_key)
            component = table["component"].to_numpy()
            mixed = np.minimum.reduceat(component, starts) != np.maximum.reduceat(component, starts)
            alone &= mixed
            lengths = (ends - starts)[alone]
            inside = np.flatnonzero(np.repeat(alone, ends - starts))
            part = table.take(pa.array(inside))
            paired = np.zeros(len(inside), bool)
            for a, b in _pairs_ahead(part, np.cumsum(lengths) - lengths, percent):
                paired[a] = paired[b] = True
            if paired.any():
                yield from given(part.take(pa.array(np.flatnonzero(paired))), 0, True)
        if held:
            yield from given(held[0], task + number, False)

    return run


def _compare(percent: int):
    """Pairs within each tile that the bitmaps leave, each once per so many pairs of a task."""

    def batch_of(found):
        a, b, share = (np.concatenate(columns) for columns in zip(*found, strict=True))
        _, first = np.unique(np.stack([a, b]), axis=1, return_index=True)
        return a[first], b[first], share[first]

    def run(batches):
        found, held = [], 0
        for table, starts in _whole_runs(batches, ["key", "first", "second"]):
            n, cid, block = (table.column(name).to_numpy() for name in ("n", "cid", "block"))
            own = table.column("first").to_numpy() == table.column("second").to_numpy()
            bits = table.column("bits").to_pylist()
            small = folded(bits)
            for a, b in _pairs_ahead(table, starts, percent):
                fit = own[a] | (block[a] != block[b])
                a, b, share = bounded_pairs(n, bits, small, a[fit], b[fit], percent)
                if len(a):
                    found.append((np.maximum(cid[a], cid[b]), np.minimum(cid[a], cid[b]), share))
                    held += len(a)
                if held > HELD_PAIRS:
                    found = [batch_of(found)]
                    held = len(found[0][0])
                    if held > HELD_PAIRS // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in found[0]], names=["a", "b", "share"])
                        found, held = [], 0
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in batch_of(found)], names=["a", "b", "share"])

    return run


SQL = r"""
WITH RECURSIVE w AS (
    SELECT row_number() OVER () AS uid, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
    SELECT uid, doc_id, list_distinct(list_transform(range(1, greatest(2, len(w) - 3)),
           lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM w WHERE len(w) > 0),
c AS (SELECT min(uid) AS cid, min(doc_id) AS rep, any_value(s) AS s, list(uid) AS uids
      FROM s GROUP BY list_sort(s)),
e AS (SELECT cid, len(s) AS n, unnest(s) AS g FROM c),
l AS (
    SELECT a.cid AS a, b.cid AS b FROM e a JOIN e b ON a.g = b.g AND a.cid <> b.cid
    GROUP BY a.cid, b.cid, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r(v, u) AS (SELECT cid, cid FROM c UNION SELECT r.v, l.b FROM r JOIN l ON r.u = l.a),
m AS (SELECT r.v AS cid, min(c.rep) AS component_id FROM r JOIN c ON r.u = c.cid GROUP BY r.v),
o AS (SELECT unnest(c.uids) AS uid, len(c.s) AS n, component_id FROM c JOIN m USING (cid))
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id
FROM w LEFT JOIN o USING (uid)"""


def op1_ngram_jaccard_join(spark, folder):
    return jaccard_components(spark.read.parquet(f"{folder}/documents.parquet"))
