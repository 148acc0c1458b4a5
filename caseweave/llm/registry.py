"""The operators' queries over their whole tables, and DuckDB SQL where SQL can state the same rows."""

from __future__ import annotations

from caseweave.llm import (
    chat_format, conversation_repair, decontaminate, hard_negatives, line_dedup, packing, quality_classifier, quality_rules,
    simhash, substring_dedup, suffix_dedup, token_counts, url_filter,
)
from caseweave.llm._spark import read_table


def _on_documents(operator):
    return lambda spark, sf_dir: operator(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_chat_format": lambda spark, sf_dir: chat_format.chat_format_query(read_table(spark, sf_dir, "conversations")),
    "op2_line_dedup": _on_documents(line_dedup.line_dedup_query),
    "op3_quality_rules": _on_documents(quality_rules.quality_rules),
    "op4_decontaminate": lambda spark, sf_dir: decontaminate.decontaminate_query(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    ),
    "op5_simhash": _on_documents(simhash.simhash_query),
    "op6_suffix_dedup": _on_documents(suffix_dedup.suffix_dedup_query),
    "op7_url_filter": lambda spark, sf_dir: url_filter.url_filter_query(
        read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels")
    ),
    "op8_quality_classifier": lambda spark, sf_dir: quality_classifier.quality_classifier_query(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    ),
    "op9_pack": _on_documents(packing.pack_query),
    "op10_substring_dedup": _on_documents(substring_dedup.substring_dedup_query),
    "op11_hard_negatives": lambda spark, sf_dir: hard_negatives.hard_negatives_query(read_table(spark, sf_dir, "embeddings")),
    "op12_conversation_repair": lambda spark, sf_dir: conversation_repair.conversation_repair_query(read_table(spark, sf_dir, "conversations")),
    "op13_token_counts": _on_documents(token_counts.token_counts_query),
}
ORACLES = {
    "op1_chat_format": chat_format.ORACLE_SQL,
    "op2_line_dedup": line_dedup.ORACLE_SQL,
    "op3_quality_rules": quality_rules.ORACLE_SQL,
    "op4_decontaminate": decontaminate.ORACLE_SQL,
    "op6_suffix_dedup": suffix_dedup.ORACLE_SQL,
    "op7_url_filter": url_filter.ORACLE_SQL,
    "op10_substring_dedup": substring_dedup.ORACLE_SQL,
    "op11_hard_negatives": hard_negatives.ORACLE_SQL,
    "op12_conversation_repair": conversation_repair.ORACLE_SQL,
}
