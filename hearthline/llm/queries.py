"""The registered queries of the text operators, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hearthline.llm import (
    chat,
    embedding_dedup,
    imatch,
    jaccard_join,
    licenses,
    line_dedup,
    mixing,
    packing,
    periodic_runs,
    quality,
    resampling,
    topk_search,
    toxicity,
)
from hearthline.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def _over(run: Callable[..., DataFrame], *tables: str) -> Query:
    return lambda spark, sf_dir: run(*(table(spark, sf_dir, name) for name in tables))


QUERIES: dict[str, Query] = {
    "op1_quality": _over(quality.quality_scores, "documents", "labels"),
    "op2_chat": _over(chat.conversation_digests, "conversations"),
    "op3_jaccard_join": _over(jaccard_join.shingle_components, "documents"),
    "op4_embedding_dedup": _over(embedding_dedup.vector_components, "embeddings"),
    "op5_toxicity": _over(toxicity.graded, "documents", "labels"),
    "op6_licenses": _over(licenses.license_labels, "documents"),
    "op7_imatch": _over(imatch.document_fingerprints, "documents"),
    "op8_line_dedup": _over(line_dedup.line_digest, "documents"),
    "op9_mixing": _over(mixing.mixture, "documents"),
    "op10_packing": _over(packing.packed_pieces, "documents"),
    "op11_topk_search": _over(topk_search.highest_products, "embeddings"),
    "op12_periodic_runs": _over(periodic_runs.run_digests, "documents"),
    "op13_resampling": _over(resampling.importance_ranks, "documents", "benchmark"),
}

#: The others are tested against brute force, round trips or held-out labels.
SQL: dict[str, str] = {
    "op8_line_dedup": line_dedup.SQL,
    "op9_mixing": mixing.SQL,
    "op11_topk_search": topk_search.SQL,
}
