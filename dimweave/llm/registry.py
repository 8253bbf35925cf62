"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dimweave.llm import bpe, chat, mixing, ngram_join, prefix_trie, quality_rules, spelling, suffix_repeats, token_files, topk, warc, weak_labels, wrapper

QUERIES = (
    chat.op1_chat_formatting,
    ngram_join.op2_ngram_jaccard_join,
    bpe.op3_byte_level_bpe,
    quality_rules.op4_quality_rules,
    token_files.op5_token_files,
    topk.op6_exact_top_k,
    warc.op7_warc,
    weak_labels.op8_quality_classifier,
    wrapper.op9_html_extraction,
    mixing.op10_mixing_to_weights,
    spelling.op11_spelling_variants,
    prefix_trie.op12_conversation_prefix_trie,
    suffix_repeats.op13_suffix_array_dedup,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op4_quality_rules": quality_rules.ORACLE_SQL,
        "op6_exact_top_k": topk.ORACLE_SQL,
        "op12_conversation_prefix_trie": prefix_trie.ORACLE_SQL,
    }
