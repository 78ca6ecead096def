"""Queries of the corpus operators: one opN_<name> for each."""

from __future__ import annotations

from catalogprep.llm import (
    brown_lm, embed_dedup, license_scan, merkle, mixing, periodic, pieces, quality, simhash, substring, token_store, topk_search, warc,
)

QUERIES = {
    "op1_license_scan": license_scan.query,
    "op2_embedding_dedup": embed_dedup.query,
    "op3_token_store": token_store.query,
    "op4_quality": quality.query,
    "op5_sentencepiece": pieces.query,
    "op6_lm_scoring": brown_lm.query,
    "op7_simhash": simhash.query,
    "op8_substring_dedup": substring.query,
    "op9_topk_search": topk_search.query,
    "op10_mixing": mixing.query,
    "op11_warc": warc.query,
    "op12_merkle": merkle.query,
    "op13_periodic_runs": periodic.query,
}
ORACLE = {
    "op1_license_scan": license_scan.ORACLE,
    "op2_embedding_dedup": embed_dedup.ORACLE,
    "op8_substring_dedup": substring.ORACLE,
    "op9_topk_search": topk_search.ORACLE,
    "op10_mixing": mixing.ORACLE,
    "op11_warc": warc.ORACLE,
    "op12_merkle": merkle.ORACLE,
}
