import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tallyspark.llm.packing import hilbert_key, pack
from tallyspark.llm.tokens import Encoder

PATH, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_curve_visits_neighbours():
    cells = [(x, y, z) for x in range(8) for y in range(8) for z in range(8)]
    order = sorted(cells, key=lambda cell: hilbert_key(list(cell), 3))
    assert len({hilbert_key(list(cell), 3) for cell in cells}) == 512
    assert all(sum(abs(a - b) for a, b in zip(*pair, strict=True)) == 1 for pair in zip(order, order[1:], strict=False))


def test_fast_and_exact_encoders_agree():
    fast, exact = Encoder(PATH, RANKS), Encoder(PATH)
    for text in ("Plain text, don't  split\n\n it.", "Ünï çödé – “quotes”", "日本語 <|endoftext|> x", "a<|endoftext|>b", " \n"):
        assert fast.ids(text).tolist() == exact.ids(text).tolist()
    plain = Encoder(PATH, RANKS, specials_as_text=True)
    assert 50256 not in plain.ids("a<|endoftext|>b").tolist()


def test_round_trip(odd_docs, no_docs):
    tokenizer = Tokenizer.from_file(PATH)
    pieces = pack(odd_docs, PATH, RANKS, size=64, with_ids=True).collect()
    want = Counter()
    for row in odd_docs.collect():
        want[(row.doc_id, tuple(tokenizer.encode(row.text or "", add_special_tokens=False).ids + [0]))] += 1
    # documents of one identifier are told apart by their length
    parts = defaultdict(list)
    for row in pieces:
        ids = np.frombuffer(row.ids, "<u2")
        assert len(ids) == row.length and zlib.crc32(row.ids) == row.ids_crc32
        parts[(row.doc_id, row.doc_tokens)].append((row.start, ids.tolist()))
    for (key, ids), times in want.items():
        texts = sorted(parts[(key, len(ids))])
        joined = [token for start, piece in texts[:: times] for token in piece]
        assert tuple(joined) == ids
    assert sum(row.length for row in pieces) == sum(len(ids) * times for (_, ids), times in want.items())
    fill = defaultdict(list)
    for row in pieces:
        fill[row.sequence_id].append((row.offset, row.length))
    for places in fill.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert pack(no_docs, PATH, RANKS).count() == 0


def test_little_padding_and_neighbours(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pieces = pack(docs, PATH, RANKS).collect()
    used = sum(row.length for row in pieces)
    assert used / (1024 * len({row.sequence_id for row in pieces})) > 0.95
    lang = dict(docs.select("doc_id", "lang").collect())
    together = defaultdict(list)
    for row in sorted(pieces, key=lambda row: (row.sequence_id, row.offset)):
        together[row.sequence_id].append(lang[row.doc_id])
    same = [a == b for langs in together.values() for a, b in zip(langs, langs[1:], strict=False)]
    shares = Counter(lang.values())
    by_chance = sum((count / len(lang)) ** 2 for count in shares.values())
    assert np.mean(same) > by_chance + 0.1
