"""The registered queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from . import collocations, decontaminate, embedding_dedup, html_extract, license_scan, near_dedup, periodic_runs, quality, quality_rules, revisits, sentencepiece_codec, token_counts, toxicity


def queries() -> dict:
    return {
        "op1_sentencepiece": sentencepiece_codec.op1_sentencepiece,
        "op2_toxicity": toxicity.op2_toxicity,
        "op3_token_counts": token_counts.op3_token_counts,
        "op4_quality": quality.op4_quality,
        "op5_near_dedup": near_dedup.op5_near_dedup,
        "op6_warc_revisits": revisits.op6_warc_revisits,
        "op7_license_scan": license_scan.op7_license_scan,
        "op8_embedding_dedup": embedding_dedup.op8_embedding_dedup,
        "op9_decontamination": decontaminate.op9_decontamination,
        "op10_html_extract": html_extract.op10_html_extract,
        "op11_periodic_runs": periodic_runs.op11_periodic_runs,
        "op12_quality_rules": quality_rules.op12_quality_rules,
        "op13_collocations": collocations.op13_collocations,
    }


def oracle_sql() -> dict[str, str]:
    return {"op6_warc_revisits": revisits.ORACLE, "op12_quality_rules": quality_rules.ORACLE, "op13_collocations": collocations.ORACLE}
