"""The subpackage's queries and their DuckDB counterparts."""

from tracklane.llm import common, conversation_repair, decontaminate, hard_negatives, katz_lm, packing, pii_surrogates, quality_rules, secret_scan, simhash_dedup, source_mix, token_counts, tool_calls, url_filter

QUERIES = {
    "op1_quality_rules": quality_rules.op1_quality_rules,
    "op2_simhash_dedup": simhash_dedup.op2_simhash_dedup,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_pii_surrogates": pii_surrogates.op6_pii_surrogates,
    "op7_katz_lm": katz_lm.op7_katz_lm,
    "op8_url_filter": url_filter.op8_url_filter,
    "op9_secret_scan": secret_scan.op9_secret_scan,
    "op10_tool_calls": tool_calls.op10_tool_calls,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_source_mix": source_mix.op12_source_mix,
    "op13_conversation_repair": conversation_repair.op13_conversation_repair,
}
QUERIES = {name: common.tidy(query) for name, query in QUERIES.items()}
ORACLES = {"op8_url_filter": url_filter.ORACLE_SQL, "op10_tool_calls": tool_calls.ORACLE_SQL, "op11_hard_negatives": hard_negatives.ORACLE_SQL}
