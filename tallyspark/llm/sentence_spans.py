"""Repeated passages: hash every run of consecutive sentences, keep the first, remove the others."""

from __future__ import annotations

import re
import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.sources.shared import drop_intermediates, table_scope, written_once

WHOLE_WORDS = 9  # of a sentence that is never cut
CUT_WINDOW = 5  # a longer one is cut after the word of the lowest hash in every window of so many words
RUN_SENTENCES = 3
RUN_WORDS = 25
# odd, so that they can be divided by: of characters, of words, and of pieces twice
FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
LONG_WORD = 256  # characters from which a word is hashed by itself
TOLD_RUNS = 200_000  # rows a task gives at a time
KEPT_POWERS = 1 << 20  # of a factor, from one text to the next
_ENDS = tuple(".!?\u2026\u3002\uff01\uff1f\uff0e\uff61\u0589\u061f\u06d4\u0700\u0701\u0702\u0964\u0965\u104a\u104b\u1362\u1367\u1368\u166e\u17d4\u17d5\u1803\u1809\u203c\u203d\u2047\u2048\u2049\u0f0d\u0f0e")
_CLOSERS = "\"')]}*_\u2019\u201d\u00bb\u203a\u201c\u2018\u300d\u300f\uff09\u3011\u300b\u3009\u3015\uff3d\uff5d\uff02\uff07"
# Thai, Lao, Tibetan, Burmese, Khmer, kana, bopomofo, Han: scripts that put no spaces between words
_UNSPACED = (
    r"\u0e01-\u0e4e\u0e81-\u0ece\u0f40-\u0fbc\u1000-\u1049\u1780-\u17d3\u3005-\u3007\u3041-\u30fa\u30fc-\u30ff"
    r"\u3105-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U000323af"
)
_OPENERS = r"(\[{\u300c\u300e\uff08\u3010\u300a\u3008\u3014\uff3b\uff5b\u2018\u201c"
# a letter of those scripts is a word, with the marks on it and after it
_ANY_WORD = re.compile(rf"[{_OPENERS}]*[{_UNSPACED}][^\w\s{_OPENERS}]*|[^\s{_UNSPACED}]+|\n")
_HAS_UNSPACED = re.compile(f"[{_UNSPACED}]")
_TABLE = 1 << 16  # characters above it are neither spaces nor marks
_SPACE = np.array([chr(code).isspace() for code in range(_TABLE)])
_MARK, _CLOSER = np.zeros(_TABLE, bool), np.zeros(_TABLE, bool)
_MARK[[ord(char) for char in _ENDS]] = True
_CLOSER[[ord(char) for char in _CLOSERS]] = True
_SPACE[-1] = _MARK[-1] = _CLOSER[-1] = False


class Pieces(NamedTuple):
    """A text cut into sentences, long ones into pieces. Places are in characters, ends exclusive."""

    starts: np.ndarray
    ends: np.ndarray
    sizes: np.ndarray  # words
    whole: np.ndarray  # whether a sentence ends with the piece
    hashes: np.ndarray


def cut(text: str | None) -> Pieces:
    """Pieces of a text: it ends with a sentence mark and any closing quotes or brackets, at a line feed, or at a cut of
    a long sentence. In scripts without spaces each letter is a word.

    Where a long sentence is cut depends on no word more than ``CUT_WINDOW - 1`` away, and its pieces have at most
    ``CUT_WINDOW`` words, so a repeated passage is cut alike whatever stands before it: at most 9 words pass up to the
    first common end, a run has at most 33, and at most 9 follow the last common end. Any 51 repeated words hold a run.

    Words and pieces are hashed by polynomials modulo 2^64, whose values over any span are differences of prefix sums,
    so the whole text is handled by array operations.
    """
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    first, last = _words(text or "", codes)
    if not len(first):
        return Pieces(*[np.empty(0, np.int64)] * 3, np.empty(0, bool), np.empty(0, np.uint64))
    hashes = _word_hashes(text, codes, first, last)
    stops = np.zeros(len(first), bool)
    final = np.minimum(codes[last - 1], _TABLE - 1)
    stops[_MARK[final]] = True
    for at in np.flatnonzero(_CLOSER[final]).tolist():
        stops[at] = text[first[at] : last[at]].rstrip(_CLOSERS).endswith(_ENDS)
    lines = np.searchsorted(first, np.flatnonzero(codes == 10)) - 1
    stops[lines[lines >= 0]] = True
    stops[-1] = True
    ends = np.flatnonzero(stops) + 1
    sizes = np.diff(ends, prepend=0)
    long = np.flatnonzero(np.repeat(sizes > WHOLE_WORDS, sizes))
    cuts = stops.copy()
    if len(long):
        owner = np.repeat(np.arange(len(sizes)), sizes)[long]
        cuts[long[_lowest(hashes[long], owner)]] = True
        ends = np.flatnonzero(cuts) + 1
    begins = np.concatenate([[0], ends[:-1]])
    return Pieces(
        first[begins], last[ends - 1], ends - begins, stops[ends - 1], _mixed(_spans(hashes, begins, ends, FACTORS[1]))
    )


def _words(text: str, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character of each word and the one after its last."""
    if _unspaced(text):
        found = [match.span() for match in _ANY_WORD.finditer(text) if match.group() != "\n"]
        places = np.array(found, np.int64).reshape(-1, 2)
        return places[:, 0], places[:, 1]
    space = _SPACE[np.minimum(codes, _TABLE - 1)].view(np.int8)
    edge = np.diff(space, prepend=1, append=1)
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def _word_hashes(text: str, codes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    hashes = _spans(codes.astype(np.uint64) + np.uint64(1), first, last, FACTORS[0])
    for at in np.flatnonzero(last - first >= LONG_WORD).tolist():
        hashes[at] = xxhash.xxh3_64_intdigest(text[first[at] : last[at]].encode("utf-8", "surrogatepass"))
    return _mixed(hashes)


def _spans(values: np.ndarray, first: np.ndarray, last: np.ndarray, factor: int) -> np.ndarray:
    """Polynomial of each span of values, its first one as the constant term."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _powers(factor, len(values)), dtype=np.uint64)])
    return (total[last] - total[first]) * _powers(pow(factor, -1, 1 << 64), len(values))[first]


def _mixed(hashes: np.ndarray) -> np.ndarray:
    """All bits of a hash spread over all others."""
    hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(FACTORS[2])
    hashes = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(FACTORS[3])
    return hashes ^ (hashes >> np.uint64(32))


_KNOWN: dict[int, np.ndarray] = {}


def _powers(factor: int, count: int) -> np.ndarray:
    """Powers of a factor from 0, kept for the next text."""
    known = _KNOWN.get(factor)
    if known is None or len(known) < count:
        known = np.full(max(4096, 1 << count.bit_length()), factor, np.uint64)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        if count <= KEPT_POWERS:
            _KNOWN[factor] = known
    return known[:count]


def _unspaced(text: str) -> bool:
    return not text.isascii() and _HAS_UNSPACED.search(text) is not None


def _lowest(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which places are the last lowest of some window of ``CUT_WINDOW`` places of one owner."""
    span = np.ones(len(hashes), np.int64)  # places around in which it is the lowest
    before = after = np.ones(len(hashes), bool)
    for far in range(1, CUT_WINDOW):
        same = owner[far:] == owner[:-far]
        lower, higher = same & (hashes[:-far] >= hashes[far:]), same & (hashes[far:] > hashes[:-far])
        before = before & np.concatenate([np.zeros(far, bool), lower])
        after = after & np.concatenate([higher, np.zeros(far, bool)])
        span += before.astype(np.int64) + after
    return span >= CUT_WINDOW


def run_ends(sizes: np.ndarray, run_sentences: int, run_words: int) -> list[int]:
    """For each sentence, the end (exclusive) of the shortest run from it that is long enough; 0 where there is none."""
    total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    ends = np.maximum(
        np.searchsorted(total, total[:-1] + run_words, side="left"), np.arange(len(sizes)) + run_sentences
    )
    return np.where(ends <= len(sizes), ends, 0).tolist()


def run_keys(pieces: Pieces, run_sentences: int, run_words: int) -> tuple[np.ndarray, np.ndarray]:
    """64 and 32 bits of a hash of the run that begins at each piece, as long as there is one."""
    ends = np.array(run_ends(pieces.sizes, run_sentences, run_words), np.int64)
    first = np.flatnonzero(ends)  # from some piece on the text is too short for a run
    keys, checks = (_mixed(_spans(pieces.hashes, first, ends[first], factor)) for factor in FACTORS[2:])
    return keys.view(np.int64), (checks >> np.uint64(32)).astype(np.uint32).view(np.int32)


def remove_repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run_sentences: int = RUN_SENTENCES,
    run_words: int = RUN_WORDS,
) -> DataFrame:
    """All rows and columns, the text without repeated runs, plus ``n_sentences`` and ``n_removed``.

    A run is the shortest sequence of sentences from each sentence on that has at least ``run_sentences`` sentences
    and ``run_words`` words; it is equal to another when the words are. The first occurrence, in order of (identifier,
    row, place in the text), stays; sentences covered by any other are removed with the white space before them.
    Sentences of over 9 words are cut into pieces, which stand for sentences in all this; the two counts are of whole
    sentences, and of those that lost words.

    Passages that repeat within a text count as well. Nulls stay null and texts without a run stay as they are; a null
    identifier comes first; repeated rows are documents of their own, so all but one lose their runs. An empty table
    gives no rows. Columns called ``n_sentences`` or ``n_removed``, in any case, are replaced.

    Texts are cut once, and the hashes of their runs stored until they have been compared. Runs are sorted by range of (hash, occurrence), so a
    passage that a third of all documents share is spread over tasks; all but the first row of a hash are later
    occurrences. Whether that holds for the first row of a task follows from the last rows of the tasks before it: one
    row per task. Only texts with something to remove are cut again.
    """
    names = [name for name in docs.columns if name.lower() not in ("n_sentences", "n_removed")]
    placed = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in names]).alias("row"), F.monotonically_increasing_id().alias("place")
    )
    stored = written_once(placed, "rows")
    id_type = placed.schema["row"].dataType[id_col].dataType
    keys = T.StructType([T.StructField("id", id_type), *T._parse_datatype_string(_CUT_TYPE).fields])
    scope = f"runs-{uuid.uuid4().hex}"
    with table_scope(scope):
        told = written_once(
            stored.select(
                F.col("row")[id_col].alias("id"), "place", F.col("row")[text_col].alias("text")
            ).mapInArrow(_cut(run_sentences, run_words), keys),
            "cut",
        )
    counts = written_once(told.select("place", "n_sentences"), "counts")
    runs = told.select("id", "place", "keys", "checks").mapInArrow(
        _runs, T.StructType([T.StructField("id", id_type), *T._parse_datatype_string(_RUN_TYPE).fields])
    )
    check = F.shiftright("rest", 32).cast("int")
    first = F.col("rest").bitwiseAND(F.lit((1 << 31) - 1)).cast("int")
    order = [F.col("key"), check, F.col("id").asc_nulls_first(), F.col("place"), first]
    ordered = runs.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "key", check.alias("check"), "place", first.alias("first")
    )
    found = written_once(
        ordered.mapInArrow(_later, "place long, first int, part int, key long, check int, kind int"), "later"
    )
    drop_intermediates(docs.sparkSession, scope)  # most of the disk, and not read again
    heads = found.filter(F.col("kind") == HEAD).alias("head")
    tails = found.filter(F.col("kind") == TAIL).alias("tail")
    same = (F.col("head.key") == F.col("tail.key")) & (F.col("head.check") == F.col("tail.check"))
    late = heads.join(tails, same & (F.col("tail.part") < F.col("head.part")), "left_semi")
    again = found.filter(F.col("kind") == LATER).select("place", "first").unionByName(late.select("place", "first"))
    marks = again.groupBy("place").agg(F.array_sort(F.collect_list("first")).alias("removed"))  # of one document
    joined = stored.join(counts.join(marks, "place", "left"), "place").drop("place")
    cleaned_type = T.StructType(
        [stored.schema["row"], T.StructField("cleaned", T.StringType()), T.StructField("n_sentences", T.LongType()),
         T.StructField("n_removed", T.LongType())]
    )
    cleaned = joined.mapInArrow(_clean(names.index(text_col), run_sentences, run_words), cleaned_type)
    return cleaned.select(
        *[(F.col("cleaned") if name == text_col else F.col("row")[name]).alias(name) for name in names],
        "n_sentences", "n_removed",
    )


_CUT_TYPE = "place long, n_sentences long, keys binary, checks binary"
_RUN_TYPE = "key long, rest long, place long"


def _cut(run_sentences: int, run_words: int):
    def run(batches):
        for batch in batches:
            counts, keys, checks = [], [], []
            for text in batch.column("text"):
                pieces = cut(text.as_py())
                counts.append(int(pieces.whole.sum()))
                key, check = run_keys(pieces, run_sentences, run_words)
                keys.append(key.tobytes())
                checks.append(check.tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("place"), pa.array(counts, pa.int64()),
                    pa.array(keys, pa.binary()), pa.array(checks, pa.binary()),
                ],
                names=["id", "place", "n_sentences", "keys", "checks"],
            )

    return run


def _runs(batches):
    """One row per run: ``id, key, rest, place``; ``rest`` holds the check and, in its lower half, the first piece."""
    for batch in batches:
        rows, keys, rests, held = [], [], [], 0

        def flush(batch=batch, rows=rows, keys=keys, rests=rests):
            at = pa.array(np.concatenate(rows), pa.int32())
            columns = [
                batch.column("id").take(at), pa.array(np.concatenate(keys)), pa.array(np.concatenate(rests)),
                batch.column("place").take(at),
            ]
            for one in (rows, keys, rests):
                one.clear()
            return pa.RecordBatch.from_arrays(columns, names=["id", "key", "rest", "place"])

        for row in range(batch.num_rows):
            key = np.frombuffer(batch.column("keys")[row].as_buffer(), np.int64)
            if not len(key):
                continue
            check = np.frombuffer(batch.column("checks")[row].as_buffer(), np.int32).astype(np.int64)
            rows.append(np.full(len(key), row, np.int32))
            keys.append(key)
            rests.append((check << 32) | np.arange(len(key)))
            held += len(key)
            if held > TOLD_RUNS:
                yield flush()
                held = 0
        if held:
            yield flush()


LATER, HEAD, TAIL = range(3)


def _later(batches):
    """Of sorted runs: every run whose hash the row before it has, the first row of the task, and the last one."""
    part = TaskContext.get().partitionId()
    before = None

    def rows(place, first, key, check, kind):
        size = len(place)
        columns = [pa.array(place), pa.array(first), pa.array(np.full(size, part, np.int32))]
        if kind == LATER:  # only told apart by place
            columns += [pa.nulls(size, pa.int64()), pa.nulls(size, pa.int32())]
        else:
            columns += [pa.array(key), pa.array(check)]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(np.full(size, kind, np.int32))], names=["place", "first", "part", "key", "check", "kind"]
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        key, check, place, first = (batch.column(name).to_numpy() for name in ("key", "check", "place", "first"))
        if before is None:
            yield rows(place[:1], first[:1], key[:1], check[:1], HEAD)
        same = np.concatenate([[before == (key[0], check[0])], (key[1:] == key[:-1]) & (check[1:] == check[:-1])])
        if same.any():
            yield rows(place[same], first[same], key[same], check[same], LATER)
        before = (key[-1], check[-1])
    if before is not None:
        yield rows(place[-1:], first[-1:], key[-1:], check[-1:], TAIL)


def without_runs(text: str, removed: np.ndarray, run_sentences: int, run_words: int) -> tuple[str, int]:
    """The text without the runs that begin at ``removed``, and how many sentences lost words."""
    pieces = cut(text)
    ends = np.array(run_ends(pieces.sizes, run_sentences, run_words), np.int64)
    gone = np.zeros(len(ends) + 1, np.int64)
    np.add.at(gone, removed, 1)
    np.add.at(gone, ends[removed], -1)
    gone = np.cumsum(gone)[:-1] > 0
    sentence = np.cumsum(pieces.whole) - pieces.whole
    turns = np.flatnonzero(np.diff(np.concatenate([[True], gone, [True]])))  # where stretches that stay begin and end
    limits = np.concatenate([[0], pieces.ends])
    kept = [text[limits[first] : limits[last]] for first, last in zip(turns[::2], turns[1::2], strict=True)]
    return "".join(kept) + text[limits[-1] :], len(np.unique(sentence[gone]))


def _clean(text_place: int, run_sentences: int, run_words: int):
    def run(batches):
        for batch in batches:
            texts, removals = [], []
            for text, removed in zip(batch.column("row").field(text_place), batch.column("removed"), strict=True):
                text, gone = text.as_py(), 0
                if removed.is_valid:
                    text, gone = without_runs(text, removed.values.to_numpy(), run_sentences, run_words)
                texts.append(text)
                removals.append(gone)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"), pa.array(texts, pa.string()), batch.column("n_sentences"),
                    pa.array(removals, pa.int64()),
                ],
                names=["row", "cleaned", "n_sentences", "n_removed"],
            )

    return run


def op9_sentence_spans(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return remove_repeated_passages(docs)
