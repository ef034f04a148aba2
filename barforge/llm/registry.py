"""The queries of this package and, where SQL can express them, their oracles."""

from __future__ import annotations

from barforge.llm import op1_mixing, op2_lines, op3_toxicity, op4_topk, op5_warc, op6_minhash, op7_substrings, op8_packing, op9_fingerprints, op10_urls, op11_html, op12_trie, op13_whitening

QUERIES = {
    "op1_mixing": op1_mixing.op1_mixing,
    "op2_line_dedup": op2_lines.op2_line_dedup,
    "op3_toxicity": op3_toxicity.op3_toxicity,
    "op4_topk": op4_topk.op4_topk,
    "op5_warc": op5_warc.op5_warc,
    "op6_near_duplicates": op6_minhash.op6_near_duplicates,
    "op7_substring_dedup": op7_substrings.op7_substring_dedup,
    "op8_packing": op8_packing.op8_packing,
    "op9_fingerprints": op9_fingerprints.op9_fingerprints,
    "op10_url_filter": op10_urls.op10_url_filter,
    "op11_html": op11_html.op11_html,
    "op12_trie": op12_trie.op12_trie,
    "op13_whitening": op13_whitening.op13_whitening,
}

ORACLE_SQL = {
    "op2_line_dedup": op2_lines.ORACLE,
    "op4_topk": op4_topk.ORACLE,
    "op5_warc": op5_warc.ORACLE,
    "op6_near_duplicates": op6_minhash.ORACLE,
    "op7_substring_dedup": op7_substrings.ORACLE,
    "op10_url_filter": op10_urls.ORACLE,
    "op12_trie": op12_trie.ORACLE,
}
