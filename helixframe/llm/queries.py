"""The queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from helixframe.llm import co_training, exact_dedup, html_text, language_id, line_dedup, lloyd, mixing, packing, phrases, quality_rules, simhash, token_counts, url_filter

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_html_extraction": html_text.op2_html_extraction,
    "op3_packing": packing.op3_packing,
    "op4_simhash_near_dedup": simhash.op4_simhash_near_dedup,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_mixing": mixing.op6_mixing,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_quality_classifier": co_training.op8_quality_classifier,
    "op9_url_filters": url_filter.op9_url_filters,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op11_centroid_clustering": lloyd.op11_centroid_clustering,
    "op12_phrase_collocations": phrases.op12_phrase_collocations,
    "op13_language_id": language_id.op13_language_id,
}
SQL = {
    "op1_exact_dedup": exact_dedup.SQL,
    "op6_mixing": mixing.SQL,
    "op9_url_filters": url_filter.SQL,
    "op10_quality_rules": quality_rules.SQL,
    "op11_centroid_clustering": lloyd.SQL,
    "op12_phrase_collocations": phrases.SQL,
}
