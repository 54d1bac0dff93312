"""The queries of this subpackage, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from tessera.llm import ann, decontaminate, extract, linededup, lm, pieces, quality, simhash, toxicity, urlfilter

QUERIES = {
    f.__name__: f
    for f in (
        urlfilter.op1_url_filter,
        simhash.op2_simhash_near_dedup,
        extract.op3_html_extraction,
        toxicity.op4_toxicity,
        quality.op5_quality_classifier,
        pieces.op6_sentencepiece,
        decontaminate.op7_benchmark_decontamination,
        linededup.op8_line_dedup,
        ann.op9_nearest_neighbours,
        lm.op10_lm_scoring,
    )
}
ORACLE_SQL = {"op8_line_dedup": linededup.OP8_SQL}
