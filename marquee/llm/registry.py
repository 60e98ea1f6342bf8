"""The registered queries of this subpackage, and their answers in SQL where SQL has them."""

from __future__ import annotations

from marquee.llm import (
    conversation_repair,
    exact_dedup,
    lexical_search,
    ngram_join,
    packing,
    piece_transducer,
    quality_classifier,
    quality_rules,
    secret_scans,
    substring_dedup,
    token_shards,
    url_filters,
    warc,
)

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op3_token_shards": token_shards.op3_token_shards,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_ngram_join": ngram_join.op5_ngram_join,
    "op6_secret_scans": secret_scans.op6_secret_scans,
    "op7_sentencepiece": piece_transducer.op7_sentencepiece,
    "op8_packing": packing.op8_packing,
    "op9_quality_classifier": quality_classifier.op9_quality_classifier,
    "op10_url_filters": url_filters.op10_url_filters,
    "op11_warc": warc.op11_warc,
    "op12_conversation_repair": conversation_repair.op12_conversation_repair,
    "op13_lexical_search": lexical_search.op13_lexical_search,
}

SQL = {
    "op1_exact_dedup": exact_dedup.ORACLE,
    "op4_quality_rules": quality_rules.ORACLE,
    "op5_ngram_join": ngram_join.ORACLE,
    "op10_url_filters": url_filters.ORACLE,
    "op11_warc": warc.ORACLE,
    "op13_lexical_search": lexical_search.ORACLE,
}
