"""Queries of the corpus operators over the given tables, and their SQL."""

from __future__ import annotations

from pressloom.llm import (
    captures,
    centroids,
    chat,
    decontamination,
    language,
    middle,
    mixing,
    quality,
    sharding,
    simhash,
    substrings,
    suffixes,
    urls,
)

LLM_QUERIES = {
    "op1_stratified_interleaving": sharding.op1_stratified_interleaving,
    "op2_spaced_seeds": decontamination.op2_spaced_seeds,
    "op3_robust_outliers": quality.op3_robust_outliers,
    "op4_marginal_unigrams": language.op4_marginal_unigrams,
    "op5_temporal_lists": urls.op5_temporal_lists,
    "op6_run_length_index": suffixes.op6_run_length_index,
    "op7_snapshots": chat.op7_snapshots,
    "op8_pigeonring": simhash.op8_pigeonring,
    "op9_splitting_tree": mixing.op9_splitting_tree,
    "op10_super_kmers": substrings.op10_super_kmers,
    "op11_capture_index": captures.op11_capture_index,
    "op12_middle": middle.op12_middle,
    "op13_dimension_shards": centroids.op13_dimension_shards,
}

LLM_ORACLE = {
    "op1_stratified_interleaving": sharding.OP1_SQL,
    "op6_run_length_index": suffixes.OP6_SQL,
    "op10_super_kmers": substrings.OP10_SQL,
    "op5_temporal_lists": urls.OP5_SQL,
    "op7_snapshots": chat.OP7_SQL,
    "op9_splitting_tree": mixing.OP9_SQL,
    "op11_capture_index": captures.OP11_SQL,
    "op12_middle": middle.OP12_SQL,
    "op13_dimension_shards": centroids.OP13_SQL,
}
