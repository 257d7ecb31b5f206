"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collidex.llm import (decontamination, exact_dedup, jaccard_join, main_text, merkle, packing, piece_codec, pii, quality, token_counts,
                          toxicity, url_filter, zone_clusters)

QUERIES = {
    "op1_ngram_jaccard_join": jaccard_join.query,
    "op2_exact_dedup": exact_dedup.query,
    "op3_url_filter": url_filter.query,
    "op4_benchmark_decontamination": decontamination.query,
    "op5_quality_classifier": quality.query,
    "op6_pii_surrogates": pii.query,
    "op7_toxicity": toxicity.query,
    "op8_sum_of_squares_packing": packing.query,
    "op9_main_text": main_text.query,
    "op10_bpe_token_counts": token_counts.query,
    "op11_centroid_clusters": zone_clusters.query,
    "op12_byte_bpe_codec": piece_codec.query,
    "op13_merkle_manifest": merkle.query,
}

ORACLE = {
    "op2_exact_dedup": exact_dedup.SQL,
    "op4_benchmark_decontamination": decontamination.SQL,
    "op11_centroid_clusters": zone_clusters.SQL,
    "op13_merkle_manifest": merkle.SQL,
}
