"""Queries of the package and, where SQL can say the same, their SQL."""

from __future__ import annotations

from functools import wraps
from pathlib import Path

from tallyspark.llm import (
    chat, content_sort, decontamination, dialogue_repair, filter_audit, language_id, ngram_join, packing, pseudonyms,
    sentence_spans, sharding, simhash, token_counts,
)


def find_package(spark) -> None:
    """Let the Python workers of a session find the package where this checkout is not installed."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH")
    if root not in (known or "").split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{known}" if known else root


def _prepared(query):
    @wraps(query)
    def run(spark, folder):
        find_package(spark)
        return query(spark, folder)

    return run


_ALL = {
    "op1_ngram_jaccard_join": ngram_join.op1_ngram_jaccard_join,
    "op2_hilbert_packing": packing.op2_hilbert_packing,
    "op3_hypergeometric_sharding": sharding.op3_hypergeometric_sharding,
    "op4_benchmark_decontamination": decontamination.op4_benchmark_decontamination,
    "op5_exact_dedup": content_sort.op5_exact_dedup,
    "op6_language_bitmask": language_id.op6_language_bitmask,
    "op7_chat_formatting": chat.op7_chat_formatting,
    "op8_separator_scan": token_counts.op8_separator_scan,
    "op9_sentence_spans": sentence_spans.op9_sentence_spans,
    "op10_feistel_pseudonyms": pseudonyms.op10_feistel_pseudonyms,
    "op11_lightest_repair": dialogue_repair.op11_lightest_repair,
    "op12_simhash_variants": simhash.op12_simhash_variants,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}
QUERIES = {name: _prepared(query) for name, query in _ALL.items()}

SQL = {
    "op1_ngram_jaccard_join": ngram_join.SQL,
    "op4_benchmark_decontamination": decontamination.SQL,
    "op5_exact_dedup": content_sort.SQL,
    "op7_chat_formatting": chat.SQL,
    "op11_lightest_repair": dialogue_repair.SQL,
    "op13_filter_audit": filter_audit.SQL,
}
