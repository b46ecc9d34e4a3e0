"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barsmith.llm import audit, exact_dedup, jaccard, language, lattice, licenses, mixing, packing, quality, sharding, tokenfile, topk, vector_codes


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mixing": mixing.query,
        "op2_lattice_score": lattice.query,
        "op3_sharding": sharding.query,
        "op4_language_id": language.query,
        "op5_ngram_jaccard_join": jaccard.query,
        "op6_best_fit_packing": packing.query,
        "op7_token_files": tokenfile.query,
        "op8_license_scan": licenses.query,
        "op9_quality_rules": quality.query,
        "op10_topk_search": topk.query,
        "op11_vector_codes": vector_codes.query,
        "op12_filter_audit": audit.query,
        "op13_exact_dedup": exact_dedup.query,
    }


def oracle_queries() -> dict[str, str]:
    return {
        "op8_license_scan": licenses.oracle(),
        "op10_topk_search": topk.SQL,
        "op11_vector_codes": vector_codes.SQL,
        "op12_filter_audit": audit.SQL,
        "op13_exact_dedup": exact_dedup.SQL,
    }
