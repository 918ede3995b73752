"""The pipeline against brute-force versions of its stages, each on its own input."""

import re
import zlib
from collections import defaultdict

import public_tokenizers
from test_decontamination import brute as brute_hits
from test_ngram_join import brute as brute_components
from tokenizers import Tokenizer

import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    inputs = {}
    for name, stage in corpus_pipeline.STAGES:
        rows = {row.doc_id: row.text for row in docs.collect()}
        out = stage(spark, docs, FOLDER)
        inputs[name] = (rows, out)
        if name != "packed":
            assert out.columns == docs.columns
        docs = out.cache()
    left = lambda name: {row.doc_id for row in inputs[name][1].collect()}

    rows, _ = inputs["language"]
    assert left("language") == {key for key, text in rows.items() if re.search(r"[^\W\d_]", text)}

    rows, _ = inputs["exact_duplicates"]
    groups = defaultdict(list)
    for key, text in rows.items():
        groups[text.encode().lower()].append(key)
    assert left("exact_duplicates") == {max(keys) for keys in groups.values()}

    rows, _ = inputs["near_duplicates"]
    want, _ = brute_components(list(rows.items()))
    assert left("near_duplicates") == {lowest for _, _, lowest in want}

    rows, _ = inputs["benchmark_free"]
    items = [(str(row.item_id), row.text) for row in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert left("benchmark_free") == {key for key, text in rows.items() if not brute_hits(items, text)[1]}

    rows, out = inputs["packed"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {key: tokenizer.encode(text, add_special_tokens=False).ids + [0] for key, text in rows.items()}
    covered = defaultdict(int)
    for row in out.collect():
        piece = ids[row.doc_id][row.start : row.start + row.length]
        assert row.ids_crc32 == zlib.crc32(b"".join(token.to_bytes(2, "little") for token in piece))
        covered[row.doc_id] += row.length
    assert covered == {key: len(tokens) for key, tokens in ids.items()}


def test_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
