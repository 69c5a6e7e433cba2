"""The registered queries of this subpackage: one for each operator, over whole tables."""

from __future__ import annotations

from tidepool.llm import (
    cover_queries, divergence_queries, duplicate_queries, language_queries, line_queries,
    mixing_queries, negative_queries, packing_queries, token_queries, vector_queries, warc_queries,
)
from tidepool.plans import Query


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for module in (line_queries, warc_queries, duplicate_queries, packing_queries, token_queries,
                   mixing_queries, vector_queries, language_queries, cover_queries,
                   negative_queries, divergence_queries):
        out.update(module.QUERIES)
    return out
