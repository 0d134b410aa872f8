"""The queries of this subpackage and, where SQL can say the same, their DuckDB equivalents."""

from __future__ import annotations

from forgelake.llm import (
    centroids,
    decontamination,
    exact_dedup,
    language_id,
    license_scan,
    mixing,
    quality,
    simhash,
    suffix_dedup,
    token_counts,
    toxicity,
    warc,
    whitening,
)

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.query,
    "op2_warc": warc.query,
    "op3_language_id": language_id.query,
    "op4_token_counts": token_counts.query,
    "op5_mixing": mixing.query,
    "op6_decontamination": decontamination.query,
    "op7_quality_rules": quality.query,
    "op8_license_scan": license_scan.query,
    "op9_toxicity": toxicity.query,
    "op10_simhash_near_dedup": simhash.query,
    "op11_exact_dedup": exact_dedup.query,
    "op12_centroid_clustering": centroids.query,
    "op13_embedding_whitening": whitening.query,
}

ORACLES = {
    "op2_warc": warc.SQL,
    "op6_decontamination": decontamination.SQL,
    "op5_mixing": mixing.SQL,
    "op11_exact_dedup": exact_dedup.SQL,
    "op12_centroid_clustering": centroids.SQL,
}
