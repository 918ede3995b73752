import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyspark.llm.token_counts import count_tokens, read_blocks, token_blocks

PATH, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_counts_as_tokenizer(odd_docs, no_docs, spark):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    rows = odd_docs.union(
        spark.createDataFrame([(10, "a<|endoftext|>b", None, None, None)], odd_docs.schema)
    )
    want = sorted(
        ((row.doc_id, len(tokenizer.encode(row.text or "", add_special_tokens=False).ids)) for row in rows.collect()), key=str
    )
    for size in (7, 1 << 16):
        found = count_tokens(token_blocks(rows, PATH, RANKS, block_tokens=size)).collect()
        assert sorted(((row.label, row.n_tokens) for row in found), key=str) == want
        assert all(row.closed for row in found)
    assert count_tokens(token_blocks(no_docs, PATH, RANKS)).count() == 0


def test_flat_files(spark, tmp_path):
    rng = np.random.default_rng(3)
    want = {}
    for number, tail in enumerate((0, 5)):
        lengths = [int(length) for length in rng.integers(0, 40, 30)]
        ids = np.concatenate([np.append(rng.integers(1, 50_000, length), 50_256) for length in lengths] + [np.full(tail, 7)])
        ids.astype("<u2").tofile(tmp_path / f"{number}.bin")
        want[f"{number}.bin"] = [(length, True) for length in lengths] + [(tail, False)] * (tail > 0)
    (tmp_path / "2.bin").write_bytes(b"")
    for size in (3, 64, 10_000):
        found = {}
        for row in count_tokens(read_blocks(spark, str(tmp_path), size)).orderBy("file", "ordinal").collect():
            found.setdefault(row.file.rsplit("/", 1)[1], []).append((row.n_tokens, row.closed))
        assert found == want
    (tmp_path / "bad.bin").write_bytes(b"abc")
    with pytest.raises(Exception, match="ends within an identifier"):
        read_blocks(spark, str(tmp_path)).collect()
