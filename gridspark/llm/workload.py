"""Queries of this package and their SQL, for the entry points."""

from __future__ import annotations

from . import bpe, byte_bpe, conversations, exact_dedup, hd_language, jaccard_join, kneser_ney, license_scan, mixing, periodic_runs, quality_rules, token_counts, toxicity

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_jaccard_join": jaccard_join.op3_jaccard_join,
    "op4_token_counts": token_counts.op4_token_counts,
    "op5_kneser_ney": kneser_ney.op5_kneser_ney,
    "op6_license_scan": license_scan.op6_license_scan,
    "op7_exact_dedup": exact_dedup.op7_exact_dedup,
    "op8_bpe": bpe.op8_bpe,
    "op9_hd_language": hd_language.op9_hd_language,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_byte_bpe": byte_bpe.op12_byte_bpe,
    "op13_conversation_repair": conversations.op13_conversation_repair,
}
SQL = {"op4_token_counts": token_counts.SQL, "op7_exact_dedup": exact_dedup.SQL}
