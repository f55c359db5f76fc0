"""The corpus operators as registered queries, each over its whole table."""

from __future__ import annotations

import corpus_pipeline

from . import chat_format, exact_dedup, html_text, language_id, ngram_join, packing, substring_dedup, token_counts, topk_search, word_codec


def _table(name, run):
    return lambda spark, sf_dir: run(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def queries() -> dict:
    return {
        "op1_ngram_join": _table("documents", ngram_join.near_groups),
        "op2_chat_format": _table("conversations", chat_format.format_chats),
        "op3_top_k": _table("embeddings", topk_search.top_k),
        "op4_token_counts": _table("documents", token_counts.count_tokens),
        "op5_exact_dedup": _table("documents", exact_dedup.duplicates),
        "op6_substring_dedup": _table("documents", lambda docs: substring_dedup.remove_repeats(docs).drop("kept_text")),
        "op7_word_codec": _table("documents", word_codec.encode),
        "op8_language_id": _table("documents", language_id.identify),
        "op9_packing": _table("documents", packing.pack),
        "op10_html_text": _table("pages", html_text.extract),
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_ngram_join": ngram_join.ORACLE,
        "op2_chat_format": chat_format.ORACLE,
        "op3_top_k": topk_search.ORACLE,
        "op5_exact_dedup": exact_dedup.ORACLE,
        "op6_substring_dedup": substring_dedup.ORACLE,
    }
