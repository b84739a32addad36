"""Queries and SQL of the operators, by name."""

from roadpulse.llm import (
    conversation_repair, decontaminate, html_text, language_id, line_dedup, minhash, packing, pieces, secret_scan, substring_dedup, top_k, url_filter,
    whitening,
)

QUERIES = {
    "op1_sentencepiece": pieces.op1_sentencepiece,
    "op2_benchmark_decontamination": decontaminate.op2_benchmark_decontamination,
    "op3_secret_scans": secret_scan.op3_secret_scans,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_exact_top_k": top_k.op5_exact_top_k,
    "op6_substring_dedup": substring_dedup.op6_substring_dedup,
    "op7_minhash_near_dedup": minhash.op7_minhash_near_dedup,
    "op8_language_id": language_id.op8_language_id,
    "op9_url_filters": url_filter.op9_url_filters,
    "op10_html_extraction": html_text.op10_html_extraction,
    "op11_embedding_whitening": whitening.op11_embedding_whitening,
    "op12_packing": packing.op12_packing,
    "op13_conversation_repair": conversation_repair.op13_conversation_repair,
}
SQL = {
    "op2_benchmark_decontamination": decontaminate.SQL,
    "op5_exact_top_k": top_k.SQL,
    "op6_substring_dedup": substring_dedup.SQL,
    "op7_minhash_near_dedup": minhash.SQL,
}
