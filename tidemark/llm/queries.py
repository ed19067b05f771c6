"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    bpe, chat, fingerprints, jaccard, language, lexical, packing, passages, quality, sharding, vectors, whitening, wordpiece,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sharding": sharding.op1_sharding,
        "op2_chat": chat.op2_chat,
        "op3_packing": packing.op3_packing,
        "op4_bpe": bpe.op4_bpe,
        "op5_quality": quality.op5_quality,
        "op6_language": language.op6_language,
        "op7_passages": passages.op7_passages,
        "op8_vectors": vectors.op8_vectors,
        "op9_token_counts": wordpiece.op9_token_counts,
        "op10_near_copies": jaccard.op10_near_copies,
        "op11_search": lexical.op11_search,
        "op12_whitening": whitening.op12_whitening,
        "op13_fingerprints": fingerprints.op13_fingerprints,
    }


def oracle_sql() -> dict[str, str]:
    """Counterparts of the queries that SQL can state on whole tables. Those of operators 8
    and 10 are exact, while the operators find links with a stated recall."""
    return {
        "op2_chat": chat.OP2_SQL,
        "op7_passages": passages.OP7_SQL,
        "op8_vectors": vectors.OP8_SQL,
        "op10_near_copies": jaccard.OP10_SQL,
        "op11_search": lexical.OP11_SQL,
        "op13_fingerprints": fingerprints.OP13_SQL,
    }
