"""The operators' queries, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import (ann, chat_format, differencing, exact_dedup, langid, mixing, near_dedup, packing, quality, sharding,
               spelling, turn_repair, url_filter)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_rank_order_language": langid.op1_rank_order_language,
        "op2_exact_dedup": exact_dedup.op2_exact_dedup,
        "op3_pruned_graph_search": ann.op3_pruned_graph_search,
        "op4_weighted_minhash": near_dedup.op4_weighted_minhash,
        "op5_hash_tree_sharding": sharding.op5_hash_tree_sharding,
        "op6_chat_format": chat_format.op6_chat_format,
        "op7_random_indexing_quality": quality.op7_random_indexing_quality,
        "op8_url_language_model": url_filter.op8_url_language_model,
        "op9_min_cost_mixing": mixing.op9_min_cost_mixing,
        "op10_vector_best_fit": packing.op10_vector_best_fit,
        "op11_spelling_variants": spelling.op11_spelling_variants,
        "op12_multiway_differencing": differencing.op12_multiway_differencing,
        "op13_turn_repair": turn_repair.op13_turn_repair,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    sql = {"op2_exact_dedup": exact_dedup.OP2_SQL, "op6_chat_format": chat_format.OP6_SQL,
           "pipeline": corpus_pipeline.ORACLE_SQL}
    return {name: text for name, text in sql.items() if text}
