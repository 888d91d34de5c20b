"""The queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from . import exact_dedup, fill_in_middle, language_id, license_scan, packing, quality_classifier, quality_rules, sentence_pieces, simhash, substring_dedup, token_files, toxicity, vector_codes


def queries():
    return {
        "op1_sentence_pieces": sentence_pieces.op1_sentence_pieces,
        "op2_quality_rules": quality_rules.op2_quality_rules,
        "op3_exact_dedup": exact_dedup.op3_exact_dedup,
        "op4_language_id": language_id.op4_language_id,
        "op5_best_fit_packing": packing.op5_best_fit_packing,
        "op6_quality_classifier": quality_classifier.op6_quality_classifier,
        "op7_simhash_near_dedup": simhash.op7_simhash_near_dedup,
        "op8_license_scan": license_scan.op8_license_scan,
        "op9_token_files": token_files.op9_token_files,
        "op10_substring_dedup": substring_dedup.op10_substring_dedup,
        "op11_vector_codes": vector_codes.op11_vector_codes,
        "op12_toxicity": toxicity.op12_toxicity,
        "op13_fill_in_middle": fill_in_middle.op13_fill_in_middle,
    }


def oracle_sql():
    return {
        "op2_quality_rules": quality_rules.ORACLE_SQL,
        "op3_exact_dedup": exact_dedup.ORACLE_SQL,
        "op8_license_scan": license_scan.ORACLE_SQL,
        "op11_vector_codes": vector_codes.ORACLE_SQL,
        "op13_fill_in_middle": fill_in_middle.ORACLE_SQL,
    }
