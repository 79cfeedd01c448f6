"""The queries of this subpackage, for ``__spark_entry__.py``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .fingerprint import op9_fingerprints
from .lm import op8_lm_scoring
from .mixing import op2_mixing
from .ngram_join import op4_ngram_jaccard_join
from .packing import op6_best_fit_packing
from .periodic import op11_periodic_runs
from .pii import op5_pii
from .pruned_graph import op12_nearest_neighbours
from .quality import op1_quality_classifier
from .substring import op3_substring_dedup
from .suffix_dedup import op7_suffix_array_dedup
from .trie import op13_prefix_trie
from .vectors import op10_embedding_near_dedup

QUERIES = (op1_quality_classifier, op2_mixing, op3_substring_dedup, op4_ngram_jaccard_join, op5_pii, op6_best_fit_packing, op7_suffix_array_dedup,
    op8_lm_scoring, op9_fingerprints, op10_embedding_near_dedup, op11_periodic_runs, op12_nearest_neighbours, op13_prefix_trie)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    """None of the numbered operators can be written in SQL at whole-table size; tests/llm holds them to brute force."""
    return {}
