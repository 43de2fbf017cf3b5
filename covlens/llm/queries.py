"""Registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from covlens.llm import conversations, decontaminate, htmltext, langid, lmscore, neardup, packing, pii, quality_knn, rules, substrings, toxicity, whitening

QUERIES = {
    "op1_aho_corasick": decontaminate.op1_aho_corasick,
    "op2_feistel_pseudonyms": pii.op2_feistel_pseudonyms,
    "op3_chosen_path": neardup.op3_chosen_path,
    "op4_bm25_packing": packing.op4_bm25_packing,
    "op5_byte_cnn": langid.op5_byte_cnn,
    "op6_boosted_dom": htmltext.op6_boosted_dom,
    "op7_knn_quality": quality_knn.op7_knn_quality,
    "op8_rule_ledger": rules.op8_rule_ledger,
    "op9_merged_bwt": substrings.op9_merged_bwt,
    "op10_pseudo_likelihood": lmscore.op10_pseudo_likelihood,
    "op11_glr_repair": conversations.op11_glr_repair,
    "op12_refined_whitening": whitening.op12_refined_whitening,
    "op13_clause_grammar": toxicity.op13_clause_grammar,
}

ORACLE = {
    "op1_aho_corasick": decontaminate.OP1_SQL,
    "op3_chosen_path": neardup.OP3_SQL,
    "op8_rule_ledger": rules.OP8_SQL,
    "op11_glr_repair": conversations.OP11_SQL,
}
