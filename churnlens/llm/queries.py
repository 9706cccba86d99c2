"""The corpus queries and their SQL, added to the driver contract when present."""

from __future__ import annotations

from churnlens.llm import (bpe_codec, exact_dedup, filter_audit, fingerprint, html_text, jaccard_join, language_id, license_scan, mixing,
                           substring_dedup, token_count, url_filter, whitening)
from churnlens.llm.common import bounded_batches


def _bounded(query):
    def run(spark, sf_dir: str):
        bounded_batches(spark)
        return query(spark, sf_dir)
    return run


QUERIES = {
    "op1_mix_sources": _bounded(mixing.op1_mix_sources),
    "op2_url_filter": _bounded(url_filter.op2_url_filter),
    "op3_token_counts": _bounded(token_count.op3_token_counts),
    "op4_html_text": _bounded(html_text.op4_html_text),
    "op5_fingerprints": _bounded(fingerprint.op5_fingerprints),
    "op6_exact_dedup": _bounded(exact_dedup.op6_exact_dedup),
    "op7_substring_dedup": _bounded(substring_dedup.op7_substring_dedup),
    "op8_jaccard_join": _bounded(jaccard_join.op8_jaccard_join),
    "op9_language_id": _bounded(language_id.op9_language_id),
    "op10_bpe_codec": _bounded(bpe_codec.op10_bpe_codec),
    "op11_license_scan": _bounded(license_scan.op11_license_scan),
    "op12_filter_audit": _bounded(filter_audit.op12_filter_audit),
    "op13_embedding_whitening": _bounded(whitening.op13_embedding_whitening),
}

ORACLE = {
    "op2_url_filter": url_filter.OP2_SQL,
    "op6_exact_dedup": exact_dedup.OP6_SQL,
    "op7_substring_dedup": substring_dedup.OP7_SQL,
    "op8_jaccard_join": jaccard_join.OP8_SQL,
    "op11_license_scan": license_scan.OP11_SQL,
    "op12_filter_audit": filter_audit.OP12_SQL,
}
