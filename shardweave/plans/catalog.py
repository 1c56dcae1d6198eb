"""All registered queries."""

from shardweave.plans import (  # noqa: F401
    artifact_queries, document_queries, packing_queries, score_queries, stream_queries, vocab_queries)
from shardweave.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
