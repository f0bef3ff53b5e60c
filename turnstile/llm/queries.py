"""Registered queries of the subpackage: opN_<name> over whole tables, and their SQL."""

from __future__ import annotations

from . import (ann, jaccard, mixing, packing, quality_classifier, quality_rules, ranked_search, sharding, substring,
               tensored, toxicity, warc, whitening)
from .common import table

QUERIES = {
    "op1_hash_tree_sharding": lambda s, d: sharding.op1_hash_tree_sharding(table(s, d, "documents")),
    "op2_compression_distance": lambda s, d: toxicity.op2_compression_distance(
        table(s, d, "documents"), table(s, d, "labels")),
    "op3_seed_and_extend": lambda s, d: substring.op3_seed_and_extend(table(s, d, "documents")),
    "op4_warc_revisits": lambda s, d: warc.op4_warc_revisits(table(s, d, "pages")),
    "op5_adaptive_quality_rules": lambda s, d: quality_rules.op5_adaptive_quality_rules(table(s, d, "documents")),
    "op6_minimum_bin_slack": lambda s, d: packing.op6_minimum_bin_slack(table(s, d, "documents")),
    "op7_chosen_path_join": lambda s, d: jaccard.op7_chosen_path_join(table(s, d, "documents")),
    "op8_inverted_multi_index": lambda s, d: ann.op8_inverted_multi_index(table(s, d, "embeddings")),
    "op9_mix_to_weights": lambda s, d: mixing.op9_mix_to_weights(table(s, d, "documents")),
    "op10_ftrl_quality": lambda s, d: quality_classifier.op10_ftrl_quality(
        table(s, d, "documents"), table(s, d, "labels")),
    "op11_rmq_ranked_search": lambda s, d: ranked_search.op11_rmq_ranked_search(
        table(s, d, "documents"), table(s, d, "benchmark")),
    "op12_tensored_minhash": lambda s, d: tensored.op12_tensored_minhash(table(s, d, "documents")),
    "op13_cholesky_jacobi_whitening": lambda s, d: whitening.op13_cholesky_jacobi_whitening(table(s, d, "embeddings")),
}

ORACLE = {
    "op1_hash_tree_sharding": sharding.oracle_sql(),
    "op3_seed_and_extend": substring.oracle_sql(),
    "op4_warc_revisits": warc.oracle_sql(),
    "op5_adaptive_quality_rules": quality_rules.oracle_sql(),
    "op9_mix_to_weights": mixing.oracle_sql(),
    "op11_rmq_ranked_search": ranked_search.oracle_sql(),
}
