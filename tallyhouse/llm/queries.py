"""The queries of this subpackage and their SQL; a query without SQL is tested against brute force."""

from __future__ import annotations

from tallyhouse.llm import (
    conversations,
    decontamination,
    html_text,
    license_scan,
    minhash,
    mixing,
    packing,
    pii,
    quality,
    suffix_dedup,
    token_counts,
    vectors,
    whitening,
)

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
    "op2_token_counts": token_counts.op2_token_counts,
    "op3_license_scan": license_scan.op3_license_scan,
    "op4_pii": pii.op4_pii,
    "op5_vector_duplicates": vectors.op5_vector_duplicates,
    "op6_html_text": html_text.op6_html_text,
    "op7_quality_rules": quality.op7_quality_rules,
    "op8_packing": packing.op8_packing,
    "op9_mixing": mixing.op9_mixing,
    "op10_minhash_duplicates": minhash.op10_minhash_duplicates,
    "op11_whitening": whitening.op11_whitening,
    "op12_decontamination": decontamination.op12_decontamination,
    "op13_conversation_repair": conversations.op13_conversation_repair,
}
ORACLES = {
    "op3_license_scan": license_scan.ORACLE,
    "op5_vector_duplicates": vectors.ORACLE,
    "op7_quality_rules": quality.ORACLE,
    "op9_mixing": mixing.ORACLE,
    "op10_minhash_duplicates": minhash.ORACLE,
    "op12_decontamination": decontamination.ORACLE,
}
