"""Language identification with bit-sliced Bloom filters of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SIZES = (3, 4, 5)  # bytes of UTF-8 per n-gram, word limits included
PROFILE = 5_000  # n-grams per language, the most frequent ones of all training texts
SLOTS = 1 << 17
PROBES = 3
SLICE = 1 << 18  # bytes looked at together
HELD_GRAMS = 1 << 21  # different n-grams a task counts before it hands them on
NEW_GRAMS = 1 << 19  # n-grams of a language that wait to be added to its counts
GIVEN_GRAMS = 1 << 16  # n-grams in a batch that a task hands on
SALTS = 16
UNKNOWN = "und"

_SPACE = np.uint8(32)
_LETTERS = np.full(256, _SPACE, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)
_ANY_LETTER = regex.compile(r"\p{L}")


def _pieces(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Neighbouring texts of about ``SLICE`` bytes in all and the place of the first, so that a batch of many long texts
    costs a task no more than itself; a text longer than that comes alone."""
    filled = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < len(filled):
        before = int(filled[first - 1]) if first else 0
        after = max(first + 1, int(np.searchsorted(filled, before + SLICE, side="right")))
        yield first, texts.slice(first, after - first).to_pylist()
        first = after


def _flat(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes of all texts with everything but letters blank, and the end of each text."""
    parts = [f" {text.lower()} ".encode("utf-8", "replace") for text in texts]
    return _LETTERS[np.frombuffer(b"".join(parts), np.uint8)], np.cumsum([len(part) for part in parts])


def _grams(data: np.ndarray):
    """Slices of the n-grams of a byte array: (keys, places). An n-gram lies in one word and its limits."""
    longest = max(SIZES)
    for first in range(0, len(data), SLICE):
        piece = data[first : first + SLICE + longest - 1]
        blank = piece == _SPACE
        for size in SIZES:
            count = min(SLICE, len(piece) - size + 1)
            if count <= 0:
                continue
            keys = np.full(count, size, np.uint64)
            inside = np.ones(count, bool)
            for at in range(size):
                keys = keys << np.uint64(8) | piece[at : at + count]
                if 0 < at < size - 1:
                    inside &= ~blank[at : at + count]
            places = np.flatnonzero(inside)
            yield keys[places], places + first


def _slots(keys: np.ndarray) -> list[np.ndarray]:
    """``PROBES`` slots of each key by double hashing of one mixed number."""
    mixed = (keys ^ (keys >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    start, step = mixed >> np.uint64(40), (mixed >> np.uint64(8)) | np.uint64(1)
    return [((start + np.uint64(probe) * step) & np.uint64(SLOTS - 1)).astype(np.int64) for probe in range(PROBES)]


@dataclass
class LanguageFilter:
    """Slots of language masks. ``languages`` go by training texts, so ties fall to the more frequent one."""

    languages: list[str]
    masks: np.ndarray  # (words of 64 languages, SLOTS)
    false_rate: np.ndarray

    @classmethod
    def build(cls, profiles: dict[str, np.ndarray]) -> LanguageFilter:
        languages = list(profiles)
        masks = np.zeros(((len(languages) + 63) // 64, SLOTS), np.uint64)
        filled = np.zeros(len(languages))
        for place, keys in enumerate(profiles.values()):
            word, bit = divmod(place, 64)
            for slots in _slots(keys):
                np.bitwise_or.at(masks[word], slots, np.uint64(1 << bit))
            filled[place] = np.count_nonzero(masks[word] & np.uint64(1 << bit)) / SLOTS
        if len(languages) <= 8:
            masks = masks.astype(np.uint8)
        return cls(languages, masks, filled**PROBES)

    def shares(self, texts: list[str]) -> np.ndarray:
        """Per text and language, the part of the n-grams that the language contains, less false positives."""
        data, ends = _flat(texts)
        total = np.zeros(len(texts))
        hits = np.zeros((len(self.languages), len(texts)))
        for keys, places in _grams(data):
            owner = np.searchsorted(ends, places[[0, -1]], side="right") if len(places) else None
            if owner is None:
                continue
            low, high = int(owner[0]), int(owner[1]) + 1
            limits = np.searchsorted(places, ends[low : high - 1])
            owners = np.repeat(np.arange(low, high), np.diff(np.concatenate([[0], limits, [len(places)]])))
            total += np.bincount(owners, minlength=len(texts))
            slots = _slots(keys)
            for word, masks in enumerate(self.masks):
                found = masks[slots[0]]
                for more in slots[1:]:
                    found &= masks[more]
                for place in range(word * 64, min(len(self.languages), word * 64 + 64)):
                    bit = found >> found.dtype.type(place % 64) & found.dtype.type(1)
                    hits[place] += np.bincount(owners, weights=bit, minlength=len(texts))
        expected = self.false_rate[:, None] * total
        room = np.maximum((1 - self.false_rate)[:, None] * total, 1e-9)
        return np.clip((hits - expected) / room, 0, 1)


def held_out(id_col: str = "doc_id") -> Column:
    """Documents kept from training: CRC-32 of the identifier as text, modulo 3, is 1. A null counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def learn(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", profile: int = PROFILE) -> LanguageFilter:
    """Count the n-grams of all rows with text and language, and put each language's most frequent into the filter.

    Counts are summed over all rows, in tasks first. What reaches the driver is ``profile`` numbers per language.
    """
    labelled = rows.select(
        F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).filter("text IS NOT NULL AND lang IS NOT NULL")
    counted = labelled.mapInArrow(_count, "lang string, gram long, seen long, texts long")
    summed = counted.groupBy("lang", "gram").agg(F.sum("seen").alias("seen"), F.sum("texts").alias("texts"))
    best = [(F.col("gram") == 0).desc(), F.col("seen").desc(), F.col("gram")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("gram"), F.lit(SALTS))).orderBy(*best)
    kept = summed.withColumn("rank", F.row_number().over(salted)).filter(F.col("rank") <= profile + 1)
    final = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)))
    texts: dict[str, int] = {}
    grams: dict[str, list[int]] = {}
    for row in final.filter(F.col("rank") <= profile + 1).toLocalIterator():
        if row.gram == 0:  # the number of training texts
            texts[row.lang] = row.texts
        else:
            grams.setdefault(row.lang, []).append(row.gram)
    order = sorted(texts, key=lambda lang: (-texts[lang], lang))
    return LanguageFilter.build({lang: np.array(grams.get(lang, [])[:profile], np.uint64) for lang in order})


def _count(batches):
    """Per language: n-gram counts, and under n-gram 0, which ranks first, the number of texts."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    texts: dict[str, int] = {}

    def joined(parts):
        keys, where = np.unique(np.concatenate([part[0] for part in parts]), return_inverse=True)
        return keys, np.bincount(where, weights=np.concatenate([part[1] for part in parts])).astype(np.int64)

    def flush():
        for lang, parts in held.items():
            keys, seen = joined(parts)
            columns = [np.append(np.int64(0), keys.astype(np.int64)), np.append(np.int64(0), seen)]
            columns.append(np.zeros(len(keys) + 1, np.int64))
            columns[2][0] = texts[lang]
            for at in range(0, len(keys) + 1, GIVEN_GRAMS):
                given = [pa.array(column[at : at + GIVEN_GRAMS], pa.int64()) for column in columns]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(given[0]), pa.string()), *given], names=["lang", "gram", "seen", "texts"]
                )
        held.clear()
        texts.clear()

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for first, piece in _pieces(batch.column("text")):
            by_lang: dict[str, list[str]] = {}
            for text, lang in zip(piece, langs[first : first + len(piece)], strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, members in by_lang.items():
                texts[lang] = texts.get(lang, 0) + len(members)
                parts = held.setdefault(lang, [(np.empty(0, np.uint64), np.empty(0, np.int64))])
                for keys, _ in _grams(_flat(members)[0]):
                    parts.append(np.unique(keys, return_counts=True))
                    if sum(len(part[0]) for part in parts[1:]) > max(NEW_GRAMS, len(parts[0][0])):
                        parts[:] = [joined(parts)]
            if sum(len(part[0]) for parts in held.values() for part in parts) > HELD_GRAMS:
                for parts in held.values():
                    parts[:] = [joined(parts)]
                if sum(len(parts[0][0]) for parts in held.values()) > HELD_GRAMS // 2:
                    yield from flush()
    yield from flush()


def identify(docs: DataFrame, model: LanguageFilter, text_col: str = "text") -> DataFrame:
    """All rows and columns plus ``lang_pred`` and ``score`` (part of the n-grams that the language contains).

    ``und`` and 0 stand for a null text, one without a letter, and for any text where no language was learned. Where
    languages tie, the one with more training texts wins. Only the text is looked at, and only it goes to Python; the
    other columns stay where they are. Columns of the same names are replaced; repeated rows are predicted alike.
    """
    kept = [name for name in docs.columns if name not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for column in columns:
            names, scores = np.full(len(column), len(model.languages)), np.zeros(len(column))
            for first, texts in _pieces(column):
                asked = [i for i, text in enumerate(texts) if text is not None and _ANY_LETTER.search(text)]
                if asked and model.languages:
                    shares = model.shares([texts[i] for i in asked])
                    best, places = shares.argmax(axis=0), first + np.array(asked)
                    names[places], scores[places] = best, shares[best, np.arange(len(asked))]
            known = pa.array([*model.languages, UNKNOWN], pa.string())
            yield pa.StructArray.from_arrays([known.take(pa.array(names)), pa.array(scores)], ["lang_pred", "score"])

    # not deterministic for Spark, or a filter of the result would have every text predicted again
    predicted = F.arrow_udf(predict, "lang_pred string, score double").asNondeterministic()
    found = "_".join(["found", *docs.columns])  # no column's name
    rows = docs.withColumn(found, predicted(F.col(text_col).cast("string")))
    return rows.select(
        *[F.col(f"`{name}`") for name in kept], *[F.col(f"`{found}`")[name].alias(name) for name in ("lang_pred", "score")]
    )


def learn_from(docs: DataFrame) -> LanguageFilter:
    """The filter of all documents that are not held out."""
    return learn(docs.filter(~held_out()))


def op6_language_bitmask(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = learn_from(docs)
    asked = docs.select("doc_id", "text", held_out().alias("held_out"))
    return identify(asked, model).select("doc_id", "held_out", "lang_pred", "score")
