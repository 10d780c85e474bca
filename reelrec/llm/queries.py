"""Registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline
from reelrec.llm import align, audit, bpe, decontaminate, langid, licenses, mixing, ngram_join, quality, substring, tokens, url_filter, warc

QUERIES = {
    "op1_url_filters": url_filter.op1_url_filters,
    "op2_ngram_join": ngram_join.op2_ngram_join,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_substring_dedup": substring.op4_substring_dedup,
    "op5_license_scan": licenses.op5_license_scan,
    "op6_language_id": langid.op6_language_id,
    "op7_mixing": mixing.op7_mixing,
    "op8_warc": warc.op8_warc,
    "op9_token_counts": tokens.op9_token_counts,
    "op10_quality_rules": quality.op10_quality_rules,
    "op11_token_alignment": align.op11_token_alignment,
    "op12_byte_bpe": bpe.op12_byte_bpe,
    "op13_filter_audit": audit.op13_filter_audit,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op1_url_filters": url_filter.ORACLE_SQL,
    "op2_ngram_join": ngram_join.ORACLE_SQL,
    "op3_decontaminate": decontaminate.ORACLE_SQL,
    "op7_mixing": mixing.ORACLE_SQL,
    "op8_warc": warc.ORACLE_SQL,
    "op13_filter_audit": audit.ORACLE_SQL,
}
