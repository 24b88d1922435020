"""Registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from . import decontaminate, fm_dedup, histogram_packing, near_dedup, packing, periodic_runs, pii, quality_rules, repair_grammar, sharding, token_counts, url_filter, vector_codes

QUERIES = {
    "op1_pii_surrogates": pii.op1_pii_surrogates,
    "op2_url_gbt": url_filter.op2_url_gbt,
    "op3_quality_rules": quality_rules.op3_quality_rules,
    "op4_near_dedup": near_dedup.op4_near_dedup,
    "op5_label_propagation": sharding.op5_label_propagation,
    "op6_repair_files": repair_grammar.op6_repair_files,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_fm_dedup": fm_dedup.op8_fm_dedup,
    "op9_best_fit_packing": packing.op9_best_fit_packing,
    "op10_token_counts": token_counts.op10_token_counts,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_nnls_packing": histogram_packing.op12_nnls_packing,
    "op13_vector_codes": vector_codes.op13_vector_codes,
}

ORACLE = {
    "op3_quality_rules": quality_rules.OP3_SQL,
}
