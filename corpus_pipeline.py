"""A text corpus from raw documents to packed sequences.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read again as the next stage's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.content_sort import drop_exact_duplicates
from tallyspark.llm.decontamination import decontaminate
from tallyspark.llm.language_id import UNKNOWN, identify, learn_from
from tallyspark.llm.ngram_join import keep_one_per_component
from tallyspark.llm.packing import pack
from tallyspark.llm.registry import find_package
from tallyspark.sources.shared import bound_batches, drop_intermediates, new_table_path, small_batches, table_scope

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MIN_SHARE = 0.1  # of a document's n-grams in the language found; less is no language that was learned


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned from ``docs``; where no row has a language, all stay."""
    model = learn_from(docs)
    if not model.languages:
        return docs
    found = identify(docs, model)
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_SHARE)).select(*docs.columns)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the largest identifier."""
    return drop_exact_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a Jaccard similarity of 0.8 or more."""
    return keep_one_per_component(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten words of a benchmark item."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens."""
    return pack(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    )


_ORDER = (language, exact_duplicates, near_duplicates, benchmark_free, packed)


def _tidy(stage, before):
    """A stage that first removes the intermediate tables of the stage before it.

    They are not needed any more, because that stage's result has been written and is read from there. So the disk in
    use is that of one stage. One pipeline may run at a time in an application. Python workers get small batches, also
    while the result is written after this returns.
    """

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if before is not None:
            drop_intermediates(spark, f"pipeline-{before.__name__}")
        bound_batches(spark)
        with table_scope(f"pipeline-{stage.__name__}"):
            return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [(stage.__name__, _tidy(stage, before)) for before, stage in zip((None, *_ORDER), _ORDER, strict=False)]

#: Packing and language identification have no SQL form; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    find_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    with small_batches(spark):
        for name, stage in STAGES:
            path = new_table_path(spark, f"stage-{name}")
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
