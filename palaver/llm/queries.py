"""Registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from palaver.llm import perspectives, pivot_search, url_filter
from palaver.llm.alignment import op13_alignment
from palaver.llm.bagminhash import op9_near_duplicates
from palaver.llm.context_tree import op12_lm_scores
from palaver.llm.decontaminate import op7_decontamination
from palaver.llm.langid import op8_language
from palaver.llm.packing import op10_packing
from palaver.llm.perspectives import op4_perspectives
from palaver.llm.pivot_search import op2_pivot_search
from palaver.llm.resampling import op11_resampling
from palaver.llm.sharding import op3_sharding
from palaver.llm.token_counts import op5_token_counts
from palaver.llm.toxicity import op1_toxicity
from palaver.llm.url_filter import op6_url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_pivot_search, op3_sharding, op4_perspectives, op5_token_counts, op6_url_filter,
        op7_decontamination, op8_language, op9_near_duplicates, op10_packing, op11_resampling,
        op12_lm_scores, op13_alignment,
    )
}
ORACLE: dict[str, str] = {
    "op2_pivot_search": pivot_search.ORACLE_SQL, "op4_perspectives": perspectives.ORACLE_SQL,
    "op6_url_filter": url_filter.ORACLE_SQL,
}
