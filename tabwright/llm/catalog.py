"""The queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

import corpus_pipeline
from tabwright.llm import bytenet, exact, fim, jaccard, mixing, passages, permutation, phrases, pieces, pii, quality, suffixes, tokens

QUERIES = {
    "op1_pii_spans": pii.query,
    "op2_sentencepiece": pieces.query,
    "op3_quality_rules": quality.query,
    "op4_source_mix": mixing.query,
    "op5_token_counts": tokens.query,
    "op6_substring_dedup": passages.query,
    "op7_ngram_jaccard": jaccard.query,
    "op8_quality_classifier": bytenet.query,
    "op9_suffix_dedup": suffixes.query,
    "op10_permutation_ann": permutation.query,
    "op11_fill_in_middle": fim.query,
    "op12_phrase_collocations": phrases.query,
    "op13_exact_dedup": exact.query,
    "pipeline": corpus_pipeline.run,
}
ORACLE = {
    "op4_source_mix": mixing.SQL.strip(),
    "op6_substring_dedup": passages.SQL.strip(),
    "op7_ngram_jaccard": jaccard.SQL.strip(),
    "op11_fill_in_middle": fim.SQL.strip(),
    "op12_phrase_collocations": phrases.SQL.strip(),
    "op13_exact_dedup": exact.SQL.strip(),
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(ORACLE)
