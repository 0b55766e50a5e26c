"""The queries of this package and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from markfield.llm import (
    bpe,
    chat,
    decontamination,
    exact_dedup,
    lines,
    packing,
    prefix_trie,
    quality,
    simhash,
    spellings,
    token_counts,
    toxicity,
    urls,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": packing.query,
    "op2_quality_classifier": quality.query,
    "op3_toxicity": toxicity.query,
    "op4_token_counts": token_counts.query,
    "op5_benchmark_decontamination": decontamination.query,
    "op6_chat_formatting": chat.query,
    "op7_url_filter": urls.query,
    "op8_simhash_near_dedup": simhash.query,
    "op9_line_dedup": lines.query,
    "op10_exact_dedup": exact_dedup.query,
    "op11_spelling_variant_grouping": spellings.query,
    "op12_bpe_encoding_and_decoding": bpe.query,
    "op13_conversation_prefix_trie": prefix_trie.query,
}
SQL: dict[str, str] = {
    "op6_chat_formatting": chat.SQL,
    "op10_exact_dedup": exact_dedup.SQL,
    "op11_spelling_variant_grouping": spellings.SQL,
    "op13_conversation_prefix_trie": prefix_trie.SQL,
}
