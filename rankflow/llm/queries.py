"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rankflow.llm.byte_pairs import op12_byte_pairs
from rankflow.llm.conversation_repair import op13_conversation_repair
from rankflow.llm.decontaminate import op3_decontaminate
from rankflow.llm.pairwise_quality import op4_pairwise_quality
from rankflow.llm.quality_rules import op2_quality_rules
from rankflow.llm.sentencepieces import op10_sentencepiece
from rankflow.llm.sharding import OP7_SQL, op7_sharding
from rankflow.llm.simhash_dedup import op8_simhash_dedup
from rankflow.llm.spelling_variants import op11_spelling_variants
from rankflow.llm.suffix_dedup import op6_suffix_dedup
from rankflow.llm.surrogates import op9_pii_surrogates
from rankflow.llm.token_counts import op1_token_counts
from rankflow.llm.toxicity import op5_toxicity

_QUERIES = (
    op1_token_counts,
    op2_quality_rules,
    op3_decontaminate,
    op4_pairwise_quality,
    op5_toxicity,
    op6_suffix_dedup,
    op7_sharding,
    op8_simhash_dedup,
    op9_pii_surrogates,
    op10_sentencepiece,
    op11_spelling_variants,
    op12_byte_pairs,
    op13_conversation_repair,
)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


def llm_sql() -> dict[str, str]:
    """SQL counterparts, where SQL can express the operator."""
    return {"op7_sharding": OP7_SQL}
