"""The registered queries of this subpackage and their SQL."""

from . import align, ann, bpe, chat_format, decontaminate, hard_negatives, license_scan, mixture, quality_crf, simhash_dedup, substring_dedup, token_counts, url_filter

QUERIES = {
    "op1_substring_dedup": substring_dedup.op1_query,
    "op2_simhash_dedup": simhash_dedup.op2_query,
    "op3_nearest": ann.op3_query,
    "op4_quality_crf": quality_crf.op4_query,
    "op5_chat_format": chat_format.op5_query,
    "op6_decontaminate": decontaminate.op6_query,
    "op7_mix_sources": mixture.op7_query,
    "op8_license_scan": license_scan.op8_query,
    "op9_url_filter": url_filter.op9_query,
    "op10_token_counts": token_counts.op10_query,
    "op11_hard_negatives": hard_negatives.op11_query,
    "op12_align_tokens": align.op12_query,
    "op13_bpe_codec": bpe.op13_query,
}

ORACLE: dict[str, str] = {
    "op5_chat_format": chat_format.OP5_SQL,
    "op7_mix_sources": mixture.mix_sql(),
    "op8_license_scan": license_scan.OP8_SQL,
    "op9_url_filter": url_filter.OP9_SQL,
    "op11_hard_negatives": hard_negatives.OP11_SQL,
}
