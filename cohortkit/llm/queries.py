"""Registered queries of this subpackage, and the DuckDB text of those that SQL can express."""

from __future__ import annotations

from cohortkit.llm import (chat, context_tree, fill_in_middle, fuzzy_lines, lexical_search, minhash, ngram_join, one_bit_ann, packing, quality_lines, segment,
                           separator_scan, warc)

QUERIES = {
    "op1_line_frequency": quality_lines.op1_line_frequency,
    "op2_separator_scan": separator_scan.op2_separator_scan,
    "op3_fuzzy_lines": fuzzy_lines.op3_fuzzy_lines,
    "op4_context_tree": context_tree.op4_context_tree,
    "op5_minhash_near_duplicates": minhash.op5_minhash_near_duplicates,
    "op6_best_fit_packing": packing.op6_best_fit_packing,
    "op7_chat_formatting": chat.op7_chat_formatting,
    "op8_content_addressed_warc": warc.op8_content_addressed_warc,
    "op9_rotated_one_bit": one_bit_ann.op9_rotated_one_bit,
    "op10_n_best_segmentation": segment.op10_n_best_segmentation,
    "op11_fill_in_middle": fill_in_middle.op11_fill_in_middle,
    "op12_ngram_jaccard_join": ngram_join.op12_ngram_jaccard_join,
    "op13_ranked_lexical_search": lexical_search.op13_ranked_lexical_search,
}

ORACLE_SQL = {
    "op1_line_frequency": quality_lines.ORACLE,
    "op7_chat_formatting": chat.ORACLE,
    "op8_content_addressed_warc": warc.ORACLE,
    "op9_rotated_one_bit": one_bit_ann.ORACLE,
    "op11_fill_in_middle": fill_in_middle.ORACLE,
    "op13_ranked_lexical_search": lexical_search.ORACLE,
}
