"""Registered queries of this folder and their SQL."""

from __future__ import annotations

from tidewater.llm import (bpe, collocations, decontaminate, html_text, imatch, ngram_join, oracles, quality_fm, ranked_search, repair_ids, secrets, sharding, substring_dedup,
                           warc)

QUERIES = {f.__name__: f for f in (
    sharding.op1_virtual_slot_sharding,
    bpe.op2_byte_bpe,
    decontaminate.op3_benchmark_decontamination,
    secrets.op4_secret_scan,
    imatch.op5_imatch,
    quality_fm.op6_fm_quality,
    repair_ids.op7_repair_token_ids,
    substring_dedup.op8_substring_dedup,
    ngram_join.op9_ngram_jaccard_join,
    warc.op10_warc_salvage,
    collocations.op11_phrase_collocations,
    html_text.op12_html_extraction,
    ranked_search.op13_ranked_search,
)}
ORACLE_SQL: dict[str, str] = {
    "op4_secret_scan": oracles.SECRETS,
    "op8_substring_dedup": oracles.SUBSTRINGS,
    "op9_ngram_jaccard_join": oracles.NGRAMS,
    "op10_warc_salvage": oracles.WARC,
    "op11_phrase_collocations": collocations.ORACLE_SQL,
    "op13_ranked_search": ranked_search.ORACLE_SQL,
}
