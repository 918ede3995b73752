import contextlib
import io
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tallyspark.llm import language_id, registry
from tallyspark.llm.language_id import SIZES, LanguageFilter, _flat, _grams, held_out, identify, learn


def plain_grams(text):
    out = []
    for word in "".join(letter if letter.isalpha() else " " for letter in text.lower()).split():
        data = f" {word} ".encode()
        out += [data[at : at + size] for size in SIZES for at in range(len(data) - size + 1)]
    return sorted(out)


def test_grams_as_brute_force():
    texts = ["Ab, cde!", "", "Éa 12 zz", "x" * 40]
    data, ends = _flat(texts)
    found = [[] for _ in texts]
    for keys, places in _grams(data):
        for key, place in zip(keys.tolist(), places.tolist(), strict=True):
            raw = key.to_bytes(8, "big").lstrip(b"\0")
            found[int(np.searchsorted(ends, place, side="right"))].append(raw[1:])
    assert [sorted(one) for one in found] == [plain_grams(text) for text in texts]


def test_shares_are_corrected():
    keys = np.unique(np.concatenate([keys for keys, _ in _grams(_flat(["the quick brown fox"])[0])]))
    model = LanguageFilter.build({"en": keys, "xx": np.array([], np.uint64)})
    shares = model.shares(["the quick", "zzz qqq vvv", "the quick brown fox " * 9])
    assert shares[0, 0] > 0.99 and shares[0, 1] < 0.05 and shares[0, 2] > 0.99
    assert shares[1].max() == 0


def test_more_than_64_languages():
    keys = {f"l{number:02}": np.array([number + 1000], np.uint64) for number in range(70)}
    model = LanguageFilter.build(keys)
    assert model.masks.shape[0] == 2 and len(model.languages) == 70


def test_long_texts_are_counted_in_pieces(monkeypatch):
    """No more than a slice of texts, or one longer text, is looked at together, and every n-gram counts."""
    looked_at = []

    def watched(texts):
        looked_at.append((len(texts), sum(len(text.encode()) for text in texts)))
        return _flat(texts)

    monkeypatch.setattr(language_id, "_flat", watched)
    monkeypatch.setattr(language_id, "SLICE", 1000)
    monkeypatch.setattr(language_id, "NEW_GRAMS", 50)
    monkeypatch.setattr(language_id, "GIVEN_GRAMS", 7)
    texts = ["", "Éa bc ", "long words " * 200, *[f"text of {chr(97 + n % 26)}{chr(97 + n % 7)}z" for n in range(300)]]
    langs = ["en" if n % 3 else "de" for n in range(len(texts))]
    batch = pa.RecordBatch.from_arrays([pa.array(["", *texts]).slice(1), pa.array(langs)], names=["text", "lang"])
    found, seen_texts = Counter(), Counter()
    for given in language_id._count([batch]):
        for row in given.to_pylist():
            found[row["lang"], row["gram"].to_bytes(8, "big").lstrip(b"\0")[1:]] += row["seen"]
            seen_texts[row["lang"]] += row["texts"]
    want = Counter((lang, gram) for text, lang in zip(texts, langs, strict=True) for gram in plain_grams(text))
    assert +found == want and seen_texts == Counter(langs)
    assert len(looked_at) > 5 and all(count == 1 or size <= 1000 for count, size in looked_at)


def test_pieces_cover_all_rows():
    texts = pa.array([None, "", "é" * 600, None, "ab"])
    pieces = list(language_id._pieces(pa.concat_arrays([texts] * 900)))
    assert [text for _, piece in pieces for text in piece] == texts.to_pylist() * 900
    assert [first for first, _ in pieces] == np.cumsum([0, *[len(piece) for _, piece in pieces]])[:-1].tolist()
    assert len(pieces) > 2 and list(language_id._pieces(texts.slice(0, 0))) == []


def test_only_the_text_goes_to_python(spark, odd_docs):
    """Rows are not sent to Python and back beside their text, and a filter of the result predicts nothing again."""
    found = identify(odd_docs, learn(odd_docs)).filter("lang_pred <> 'und' AND score >= 0.1")
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        found.explain("simple")
    assert text.getvalue().count("ArrowEvalPython") == 1 and "MapInArrow" not in text.getvalue()
    assert found.count() > 0


def test_odd_rows(spark, odd_docs, no_docs):
    model = learn(odd_docs)
    found = identify(odd_docs.withColumn("score", F.lit(1)), model)
    assert found.columns == [*odd_docs.columns, "lang_pred", "score"]
    rows = found.collect()
    assert len(rows) == odd_docs.count()
    for row in rows:
        if not any(letter.isalpha() for letter in row.text or ""):
            assert (row.lang_pred, row.score) == ("und", 0)
        else:
            assert 0 <= row.score <= 1
    assert {row.lang_pred for row in rows if row.doc_id == 8} == {"fr"}
    nothing = learn(no_docs)
    assert nothing.languages == []
    assert {row.lang_pred for row in identify(odd_docs, nothing).collect()} == {"und"}
    assert identify(no_docs, model).count() == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    found = registry.QUERIES["op6_language_bitmask"](spark, folder)
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").collect()
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1) for row in rows)
    asked = [row for row in rows if row.held_out]
    assert sum(row.lang == row.lang_pred for row in asked) >= 0.98 * len(asked)
    assert spark.range(1).select(held_out("id")).count() == 1
