"""The subpackage's queries and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from firmlens.llm import alignment, bpe, chat, classifier, divergence, mixing, near_dedup, quality_rules, simhash, suffix_dedup, token_files, topk, warc

QUERIES = {
    "op1_topk_search": topk.op1_topk_search,
    "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
    "op3_near_dedup": near_dedup.op3_near_dedup,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_quality_classifier": classifier.op5_quality_classifier,
    "op6_mix_sources": mixing.op6_mix_sources,
    "op7_chat_format": chat.op7_chat_format,
    "op8_token_files": token_files.op8_token_files,
    "op9_warc": warc.op9_warc,
    "op10_bpe": bpe.op10_bpe,
    "op11_divergence_audit": divergence.op11_divergence_audit,
    "op12_simhash_dedup": simhash.op12_simhash_dedup,
    "op13_tokenizer_alignment": alignment.op13_tokenizer_alignment,
}

ORACLE_SQL = {
    "op1_topk_search": topk.OP1_SQL,
    "op4_quality_rules": quality_rules.OP4_SQL,
    "op6_mix_sources": mixing.OP6_SQL,
    "op7_chat_format": chat.OP7_SQL,
    "op9_warc": warc.OP9_SQL,
    "op11_divergence_audit": divergence.OP11_SQL,
}
