"""The registered queries of this subpackage, and the SQL that checks those that SQL can express."""

from . import (ann_codes, chat_format, html_text, line_dedup, mixing, packing, quality_crf, quality_rules, resampling,
               simhash, token_counts, url_filter, vector_codes)

QUERIES = {
    "op1_line_dedup": line_dedup.query,
    "op2_ann_codes": ann_codes.query,
    "op3_chat_format": chat_format.query,
    "op4_url_filter": url_filter.query,
    "op5_simhash": simhash.query,
    "op6_mixing": mixing.query,
    "op7_html_text": html_text.query,
    "op8_quality_rules": quality_rules.query,
    "op9_quality_crf": quality_crf.query,
    "op10_packing": packing.query,
    "op11_resampling": resampling.query,
    "op12_token_counts": token_counts.query,
    "op13_vector_codes": vector_codes.query,
}

ORACLE = {
    "op1_line_dedup": line_dedup.SQL,
    "op2_ann_codes": ann_codes.SQL,
    "op3_chat_format": chat_format.SQL,
    "op6_mixing": mixing.SQL,
    "op11_resampling": resampling.SQL,
    "op13_vector_codes": vector_codes.SQL,
}
