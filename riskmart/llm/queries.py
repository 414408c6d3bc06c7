"""Registered queries of this subpackage, with their SQL twins where SQL can express them."""

from __future__ import annotations

from functools import wraps

from riskmart.llm import (
    ann, chat_format, exact_dedup, html_extract, language_id, mixing, ngram_join, packing, quality, spelling, token_counts, toxicity, whitening,
)
from riskmart.llm.common import ship


def _shipped(query):
    @wraps(query)
    def run(spark, sf_dir):
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {
    name: _shipped(query)
    for name, query in {
        "op1_toxicity": toxicity.op1_toxicity,
        "op2_token_counts": token_counts.op2_token_counts,
        "op3_exact_dedup": exact_dedup.op3_exact_dedup,
        "op4_nearest_vectors": ann.op4_nearest_vectors,
        "op5_identify_language": language_id.op5_identify_language,
        "op6_mix_sources": mixing.op6_mix_sources,
        "op7_format_chats": chat_format.op7_format_chats,
        "op8_pack_sequences": packing.op8_pack_sequences,
        "op9_ngram_jaccard": ngram_join.op9_ngram_jaccard,
        "op10_extract_pages": html_extract.op10_extract_pages,
        "op11_whiten_embeddings": whitening.op11_whiten_embeddings,
        "op12_spelling_variants": spelling.op12_spelling_variants,
        "op13_quality_rules": quality.op13_quality_rules,
    }.items()
}
ORACLES = {
    "op3_exact_dedup": exact_dedup.OP3_SQL,
    "op6_mix_sources": mixing.OP6_SQL,
    "op7_format_chats": chat_format.OP7_SQL,
    "op9_ngram_jaccard": ngram_join.OP9_SQL,
}
